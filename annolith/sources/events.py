"""The events of a run, derived from its tables: one row each, with a key by which a repeated delivery is dropped and a position that
puts a run's events in the order in which they bring each other about."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.plans.runs import Run

# The types of events, in the order in which a task brings them about.
TYPES = (
    "taxonomy.version.created", "run.created", "generation.task.created", "seed.rejected", "seed.validated", "data.generated", "data.deterministic.validated",
    "data.generation.rejected", "data.verification.judged", "data.verification.rejected", "sample.formatted", "sample.accepted", "generation.task.rejected", "generation.task.replaced", "run.completed", "run.failed",
)


#: What ends a task.
CLOSING_OF_TASK = ("sample.formatted", "sample.accepted", "generation.task.rejected", "generation.task.replaced")
#: Types that come before all tasks, and after them; the others go task by task.
OPENING, CLOSING = ("taxonomy.version.created", "run.created", "generation.task.created"), ("run.completed", "run.failed")


def position(kind: str, task: Column, attempt: Column, draw: Column, late: bool = False) -> Column:
    """A long that grows along a run's events: opening events, then task by task, attempt by attempt (127 at most), seed draw by
    draw (31), step by step, and the closing one. A key made of what the event is about, so no event looks at another.
    late: the task was created while the run went on, in place of another."""
    phase = 1 if late else 0 if kind in OPENING else 2 if kind in CLOSING else 1
    step, zero = F.lit(TYPES.index(kind)).cast("long"), F.expr("0L")
    rank = lambda c, bits: F.call_function("shiftleft", F.coalesce(c.cast("long"), zero), F.lit(bits))
    own = rank(task, 17) + rank(attempt, 10) + rank(draw, 5) if phase else F.call_function("shiftleft", step, F.lit(48)) + F.coalesce(task.cast("long"), zero)
    return F.call_function("shiftleft", F.lit(phase).cast("long"), F.lit(60)) + own + (step if phase else zero)


def _event(rows: DataFrame, kind: str, cause: Column, key: list, payload: Column, run: Column | None = None, late: bool = False) -> DataFrame:
    none = F.lit(None).cast("long")
    task, attempt, draw = (F.col(c) if c in rows.columns else none for c in ("sequence_no", "attempt_no", "seed_try"))
    if kind in CLOSING_OF_TASK:  # after whatever attempt was the task's last
        attempt = F.lit(127)
    key = F.concat_ws(":", F.lit(kind), *key)
    return rows.select(F.lit(kind).alias("event_type"), (F.col("run_id") if run is None else run).cast("string").alias("correlation_id"), cause.cast("string").alias("causation_id"), key.alias("idempotency_key"), F.to_json(payload).alias("payload"), position(kind, task, attempt, draw, late).alias("position"))


def _replaced(tasks: DataFrame) -> DataFrame:
    """Tasks that replace others, with the replaced one's number as their place in the order of events."""
    old = tasks.select(F.col("task_id").alias("parent_task_id"), "sequence_no")
    return tasks.where("parent_task_id is not null").select("run_id", "task_id", "slot_no", "parent_task_id", F.col("sequence_no").alias("new_no")).join(old, "parent_task_id")


def run_events(run: Run, occurred_at: str, taxonomy: DataFrame | None = None) -> DataFrame:
    """(event_id, event_type, event_version, occurred_at, correlation_id, causation_id, idempotency_key, payload, position) of a run.

    A type's rows come from the table that shows it; occurred_at is the run's time, so that a replay gives equal events."""
    spark, name = run.tasks.sparkSession, F.lit(run.config.run_name)
    task, n = F.col("task_id"), F.col("attempt_no").cast("string")
    decoys = F.transform("decoys", lambda d: F.struct(d["strategy_id"].alias("strategy_id"), d["value"].alias("value")))
    pack = F.struct(F.col("attempt_no").alias("attempt"), F.col("context_frame_id").alias("frame"), F.col("positives"), decoys.alias("decoys"))
    one, made = spark.range(1), F.struct("sequence_no", "sample_type", "difficulty", "focus_labels")
    done, tasks = run.attempts, run.tasks
    judged = done.where("size(stages) > 0")
    failed = done.where("outcome not in ('PASS', 'FIXED', 'VERIFYING')")
    closing = "run.completed" if run.status == "COMPLETED" else "run.failed"
    found = [
        _event(one, "run.created", name, [name], F.struct(F.lit(run.config.num_samples).alias("num_samples")), name),
        _event(tasks.where("parent_task_id is null"), "generation.task.created", task, [task], made),
        _event(tasks.where("parent_task_id is not null"), "generation.task.created", task, [task], made, late=True),
        _event(run.unfit, "seed.rejected", task, [task, n, F.col("seed_try").cast("string")], F.struct("pack_issues")),
        _event(run.packs, "seed.validated", task, [task, n], pack),
        _event(done, "data.generated", task, [task, n], F.struct("attempt_no", F.sha2("tagged_text", 256).alias("output_hash"))),
        _event(done, "data.deterministic.validated", task, [task, n], F.struct("attempt_no", "route")),
        _event(failed.where("size(stages) = 0"), "data.generation.rejected", task, [task, n], F.struct("attempt_no", "issues")),
        _event(judged, "data.verification.judged", task, [task, n], F.struct("attempt_no", "outcome", "stages")),
        _event(failed.where("size(stages) > 0"), "data.verification.rejected", task, [task, n], F.struct("attempt_no", "outcome", "issues")),
        _event(run.accepted, "sample.formatted", task, [task], F.struct(F.size("formatted.entities").alias("spans"))),
        _event(run.accepted, "sample.accepted", task, [task], F.struct("slot_no", "replacement_no")),
        _event(tasks.where("status = 'REJECTED'"), "generation.task.rejected", task, [task], F.struct("sequence_no", "replacement_no")),
        _event(_replaced(tasks), "generation.task.replaced", F.col("parent_task_id"), [F.col("parent_task_id")], F.struct("task_id", F.col("new_no").alias("sequence_no"), "slot_no")),
    ]
    if run.status != "RUNNING":
        found.append(_event(one, closing, name, [name], F.struct(F.lit(run.config.num_samples).alias("num_samples")), name))
    if taxonomy is not None:
        found.append(_event(taxonomy.agg(F.count("*").alias("labels")), "taxonomy.version.created", name, [name], F.struct("labels"), name))
    rows = reduce(DataFrame.unionByName, found)
    return rows.select(F.md5("idempotency_key").alias("event_id"), "event_type", F.lit(1).alias("event_version"), F.lit(occurred_at).cast("timestamp").alias("occurred_at"), "correlation_id", "causation_id", "idempotency_key", "payload", "position")
