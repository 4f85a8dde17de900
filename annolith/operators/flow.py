"""Routing of validated candidates, attempt rounds, slot lineage, usage ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Issue types that reject, and that a repair can fix.
REJECTING = ("credential_risk", "real_pii_risk")
FIXABLE = ("missing_entity_metadata", "invalid_output")
CATEGORIES = ("generator", "judge", "repair", "final_judge")


def route(types: Column) -> Column:
    """struct<status, severity> of a candidate's distinct issue types."""
    lits = lambda xs: F.array(*(F.lit(x) for x in xs))
    verdict = lambda s, v: F.struct(F.lit(s).alias("status"), F.lit(v).cast("string").alias("severity"))
    fixable = F.array_contains(types, "missing_entity_metadata") & (F.size(F.array_except(types, lits(FIXABLE))) == 0)
    return (
        F.when(F.size(types) == 0, verdict("PASS", None))
        .when(F.arrays_overlap(types, lits(REJECTING)), verdict("REJECTED", "critical"))
        .when(fixable, verdict("FIXABLE", "low"))
        .otherwise(verdict("REGENERATE", "high"))
    )


def decision_error(status: Column, severities: Column) -> Column:
    """Why a verifier's decision contradicts itself, or null."""
    none = F.size(severities) == 0
    return (
        F.when((status == "PASS") & ~none, "PASS with issues")
        .when((status != "PASS") & none, "no issues")
        .when((status == "FIXABLE") & F.exists(severities, lambda s: s != "low"), "FIXABLE needs low severity")
        .when((status == "REJECTED") & ~F.array_contains(severities, "critical"), "REJECTED needs a critical issue")
    )


def worst_scope(scopes: Column) -> Column:
    """What a new attempt rebuilds: SEEDS before CONTEXT before TEXT; null without issues."""
    return F.when(F.array_contains(scopes, "SEEDS"), "SEEDS").when(F.array_contains(scopes, "CONTEXT"), "CONTEXT").when(F.size(scopes) > 0, "TEXT")


def gate(status: Column, quality: bool) -> Column:
    """What happens next: without quality checks a pass is accepted unjudged, and what could be fixed is made anew."""
    if quality:
        return F.when(status == "PASS", "JUDGE").when(status == "FIXABLE", "REPAIR").when(status == "REJECTED", "REJECT").otherwise("REGENERATE")
    return F.when(status == "PASS", "ACCEPT").when(status == "REJECTED", "REJECT").otherwise("REGENERATE")


def pending(tasks: DataFrame) -> DataFrame:
    """Tasks without a final status, in order."""
    return tasks.where(~F.col("status").isin("ACCEPTED", "REJECTED")).orderBy("sequence_no")


def latest_in_slot(tasks: DataFrame, *slot: str) -> DataFrame:
    """For each slot the row of its last replacement."""
    newest = Window.partitionBy(*slot).orderBy(F.desc("replacement_no"), F.desc("sequence_no"))
    return tasks.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def replacements(rejected: DataFrame, last_sequence_no: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """(tasks that take the rejected ones' slots with new numbers, seeds and ids; tasks whose slot's budget is spent)."""
    open_ = rejected.where(F.col("replacement_no") < budget)
    number = F.row_number().over(Window.partitionBy("run_id").orderBy("sequence_no"))
    new = open_.withColumns({
        "parent_task_id": F.col("task_id"),
        "sequence_no": (number + last_sequence_no).cast("int"),
        "replacement_no": F.col("replacement_no") + 1,
    })
    seq = F.col("sequence_no").cast("string")
    new = new.withColumns({"task_id": F.md5(F.concat_ws("|", "parent_task_id", seq)), "task_seed": F.conv(F.substring(F.md5(F.concat_ws("|", "task_seed", seq)), 1, 8), 16, 10).cast("long"), "status": F.lit("CREATED")})
    return new, rejected.where(F.col("replacement_no") >= budget)


def next_attempt(tasks: DataFrame, candidates: DataFrame) -> DataFrame:
    """tasks (task_id, status, max_attempts) with attempt_no: where work goes on, null if no attempt is left.

    A task whose last candidate (task_id, attempt_no) is still being checked goes on with that attempt, any other with the next."""
    last = candidates.groupBy("task_id").agg(F.max("attempt_no").alias("_last"))
    rows = tasks.join(last, "task_id", "left")
    at = F.coalesce("_last", F.lit(0)) + F.when(F.col("status").isin("VALIDATING", "VERIFYING") & F.col("_last").isNotNull(), 0).otherwise(1)
    return rows.withColumn("attempt_no", F.when(at <= F.col("max_attempts"), at).cast("int")).drop("_last")


def batch(tasks: DataFrame, limit: int, batch_size: int) -> DataFrame:
    """The first pending tasks, as many as the smaller of both bounds."""
    return pending(tasks).limit(min(limit, batch_size))


def new_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Of candidates (task_id, attempt_no, ...) one each, without those that are known already."""
    return first_by_key(candidates, ["task_id", "attempt_no"], ["task_id"]).join(known.select("task_id", "attempt_no"), ["task_id", "attempt_no"], "left_anti")


def ledger(attempts: DataFrame) -> DataFrame:
    """(run_id, slot_no, task_id, attempt_no, category, input_tokens, output_tokens, money_cost) of attempts: one row for the
    generator's call and one, without tokens of its own, for each judging stage."""
    from annolith.functions.text import token_cost

    base = ("run_id", "slot_no", "task_id", "attempt_no")
    generated = attempts.select(*base, F.lit("generator").alias("category"), "input_tokens", "output_tokens")
    judged = attempts.select(*base, F.explode("stages").alias("category"), F.lit(0).alias("input_tokens"), F.lit(0).alias("output_tokens"))
    return generated.unionByName(judged).withColumn("money_cost", token_cost(F.col("input_tokens"), F.col("output_tokens")))


def accepted_samples(tasks: DataFrame, samples: DataFrame) -> DataFrame:
    """samples (task_id, ...) of accepted tasks (task_id, slot_no, replacement_no, status), in order of slot and replacement."""
    done = tasks.where(F.col("status") == "ACCEPTED").select("task_id", F.coalesce("slot_no", "sequence_no").alias("slot_no"), "replacement_no")
    return samples.join(done, "task_id").orderBy("slot_no", "replacement_no")


def first_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: idempotent events, recorded calls."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def deliveries(events: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys..., id_col, deliveries): the first event of each key and how often it came."""
    return events.groupBy(*keys).agg(F.min(id_col).alias(id_col), F.count("*").alias("deliveries"))


def usage_by_slot(calls: DataFrame, slot: list[str]) -> DataFrame:
    """Tokens in, out and cost of each slot, by category and in all; calls: (slot..., category, input_tokens, output_tokens, money_cost)."""
    each = []
    for c in CATEGORIES:
        mine = lambda x, c=c: F.coalesce(F.sum(F.when(F.col("category") == c, F.col(x))), F.lit(0))
        each += [mine("input_tokens").cast("long").alias(f"{c}_input"), mine("output_tokens").cast("long").alias(f"{c}_output")]
    return calls.groupBy(*slot).agg(*each, F.sum(F.col("input_tokens") + F.col("output_tokens")).cast("long").alias("total_tokens"), F.sum("money_cost").cast("decimal(20,8)").alias("money_cost"))
