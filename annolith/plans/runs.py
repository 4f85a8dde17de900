"""A whole run: plan, seed, generate, check, judge, retry, replace, format; with a record of all that happened."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith import shared
from annolith.functions import rng, tags
from annolith.operators import audit, flow, novelty, samples, verify
from annolith.plans import catalog, guidance
from annolith.plans.planner import RunConfig, compatible_frames, plan_tasks
from annolith.plans.strategies import strategies
from annolith.sources.clients import offline_judge, offline_repair

DOCUMENTS = {k: v[1] for k, v in catalog.FRAMES.items()}
REFLECTION = "struct<mandatory_repairs:array<string>,must_not_repeat:array<struct<type:string,reason:string>>>"
Step = Callable[[DataFrame], DataFrame]


@dataclasses.dataclass
class Run:
    """Tables of a run. tasks: all with final status; packs: accepted seed packs; unfit: refused ones; attempts: every candidate with
    route and outcome; accepted: formatted samples; lost: last candidates of slots that stay empty; waiting: candidates whose
    judging failed for reasons of infrastructure and can be taken up again."""

    config: RunConfig
    tasks: DataFrame
    packs: DataFrame
    unfit: DataFrame
    attempts: DataFrame
    accepted: DataFrame
    lost: DataFrame
    waiting: DataFrame
    status: str

    def __iter__(self):
        return iter((self.accepted, self.lost))


def _only(config: RunConfig) -> bool:
    return config.hard_negative_mode == "decoy_only"


def _add(have: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if have is None else have.unionByName(more)


def seed_rounds(tasks: DataFrame, config: RunConfig, cut: Step, stride: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(packs without issues, refused packs, tasks that max_seed_pack_attempts draws gave no fit pack).

    A refused pack is drawn anew, its values from `stride` numbers further on (as many as tasks and their replacements can have); refused ones carry seed_try and pack_issues. A task without a frame has an issue of scope CONTEXT."""
    registry, names = strategies(tasks.sparkSession), tasks.columns
    stride = stride or config.num_samples * (config.max_task_replacements + 1)
    left, fit, refused = tasks, None, None
    for n in range(1, config.max_seed_pack_attempts + 1):
        draw = (F.col("seed_attempt") - 1) * config.max_seed_pack_attempts + n - 1
        drawn = samples.seed_packs(left, registry, config.random_seed, F.concat_ws(".", "seed_attempt", F.lit(n)), _only(config), config.min_decoys, config.max_decoys, draw, stride)
        checked = samples.seed_pack_issues(drawn, registry, _only(config), config.min_decoys, config.max_decoys, config.reject_mixed_locale)
        frameless = F.array(F.struct(F.lit("incompatible_context_frame"), F.lit("CONTEXT"), F.lit("no frame supports all labels"), F.lit(None).cast("string"), F.lit(None).cast("string")).cast(samples.ISSUE))
        checked = checked.withColumn("pack_issues", F.when(F.col("context_frame_id").isNull(), F.concat(frameless, "pack_issues")).otherwise(F.col("pack_issues")))
        done = cut(checked.withColumn("seed_try", F.lit(n)))
        fit, refused = _add(fit, done.where("size(pack_issues) = 0")), _add(refused, done.where("size(pack_issues) > 0"))
        left = done.where("size(pack_issues) > 0").select(*names)
        if left.isEmpty():
            break
    return fit.drop("pack_issues"), refused, left


def candidates(spark: SparkSession, tasks: DataFrame, config: RunConfig, attempt: int | Column = 1, draw: int | Column = 0, stride: int = 0) -> DataFrame:
    """Offline candidates of tasks with their issues: seeds and look-alikes of this attempt, rendered text."""
    packs = samples.seed_packs(tasks, strategies(spark), config.random_seed, attempt, _only(config), config.min_decoys, config.max_decoys, draw, stride)
    return check(samples.render(packs, DOCUMENTS, config.structure, config.custom_instruction, _only(config)), config)


def check(rows: DataFrame, config: RunConfig) -> DataFrame:
    return samples.validate(rows, _only(config), config.pure_negative_structured_scan, config.hard_negative_structured_scan)


def guided(packs: DataFrame, taxonomy: DataFrame | None, config: RunConfig) -> DataFrame:
    """packs with the context that a taxonomy gives them, if there is one, dealt over all cores: few bytes make much work from here on."""
    many = shared.tasks(packs.sparkSession, packs.count())
    if taxonomy is not None:
        context = guidance.taxonomy_context(packs.select("task_id", "sample_type", "focus_labels"), taxonomy, config.random_seed)
        packs = packs.join(context.select("task_id", "context"), "task_id")
    # by another column too, as Spark drops a shuffle by the key of the join before it
    return packs.repartition(many, "task_id", "sequence_no")


def guard_imitation(rows: DataFrame) -> DataFrame:
    """rows (tagged_text, issues, context) with an issue for a text that is too much like an example of its guidance."""
    examples = F.transform("context.focus.examples", lambda e: e["expected_tagged_text"])
    best = audit.closest_example(F.col("tagged_text"), examples)
    issue = F.struct(F.lit("few_shot_imitation"), F.lit("TEXT"), F.lit("too much like an example"), F.lit(None).cast("string"), F.lit(None).cast("string")).cast(samples.ISSUE)
    rows = rows.withColumn("_best", best)
    rows = rows.withColumn("issues", F.when(audit.imitates(F.col("_best")), F.array_append("issues", issue)).otherwise(F.col("issues"))).drop("_best")
    return rows.withColumn("valid", F.size("issues") == 0)


def guard_novelty(rows: DataFrame, accepted: DataFrame | None, config: RunConfig) -> DataFrame:
    """rows with novelty struct<max_similarity, nearest, issues>, held against what the run accepted before and, in order, this round.

    With novelty_mode enforce the issues of an otherwise valid row become its own."""
    values = F.transform("decoys", lambda d: d["value"])
    shown = lambda df, prior: df.select("run_id", "sequence_no", tags.skeleton(F.col("tagged_text"), values).alias("skeleton"), "entities", "valid", F.lit(prior).alias("prior"))
    known = shown(rows, False) if accepted is None else shown(rows, False).unionByName(shown(novelty.last_accepted(accepted, config.novelty_recent_window), True))
    found = novelty.guard(known, config.novelty_mode, limit=config.near_duplicate_threshold, window=config.novelty_recent_window, feedback=config.max_novelty_feedback)
    found = found.select("run_id", "sequence_no", F.struct("max_similarity", "nearest", F.col("novelty_issues").alias("issues")).alias("novelty"))
    rows = rows.drop("novelty").join(found, ["run_id", "sequence_no"])
    own = F.transform("novelty.issues", lambda i: F.struct(i["type"], i["scope"], F.lit("not new to the run"), i["label"], i["value"]).cast(samples.ISSUE))
    if config.novelty_mode == "enforce":
        rows = rows.withColumn("issues", F.when(F.size("issues") == 0, own).otherwise(F.col("issues")))
    return rows.withColumn("valid", F.size("issues") == 0)


def other_frame(seed: int, *key) -> Column:
    """A compatible frame that isn't the present one; the present one where there is no other."""
    others = F.filter(compatible_frames(F.col("focus_labels")), lambda f: f != F.col("context_frame_id"))
    picked = F.get(others, (rng.bits(seed, "other_frame", *key) % F.greatest(F.size(others), F.lit(1))).cast("int"))
    return F.coalesce(picked, F.col("context_frame_id"))


def regenerate(rows: DataFrame, seed: int) -> DataFrame:
    """Failed candidates with the task of their next attempt, by the widest scope of their issues, and what the next attempt has to heed.

    TEXT keeps seeds and frame, SEEDS draws new seeds, CONTEXT keeps the seeds in another frame: seed_frame_id is the frame in
    which they were drawn, null if that is the present one."""
    none = F.lit(None).cast("string")
    drawn_in = F.col("seed_frame_id") if "seed_frame_id" in rows.columns else none
    scope = flow.worst_scope(F.transform("issues", lambda i: i["scope"]))
    rows = rows.withColumn("_scope", scope)
    return rows.withColumns({
        "context_frame_id": F.when(F.col("_scope") == "CONTEXT", other_frame(seed, F.col("task_id"), F.col("attempt_no").cast("string"))).otherwise(F.col("context_frame_id")),
        "seed_attempt": F.col("seed_attempt") + F.when(F.col("_scope") == "SEEDS", 1).otherwise(0),
        "seed_frame_id": F.when(F.col("_scope") == "SEEDS", none).when(F.col("_scope") == "CONTEXT", F.coalesce(drawn_in, "context_frame_id")).otherwise(drawn_in),
        "reflection": guidance.reflection(F.col("issues")).cast(REFLECTION),
    }).drop("_scope")


def judged(rows: DataFrame, config: RunConfig, judge: Step, repair: Step, recheck: Step, cut: Step) -> DataFrame:
    """rows with outcome, stages and, where the outcome is REGENERATE or REJECTED, the verdict's issues as their own.

    A candidate that the checks call fixable is asked of the repairing model whatever the first verdict."""
    fixable = F.col("route") == "FIXABLE"

    def first(df: DataFrame) -> DataFrame:
        df = judge(df)
        if "origin" in df.columns:
            return df
        held = df["verdict"].withField("status", F.when(fixable & (F.col("verdict.status") != "ERROR"), "FIXABLE").otherwise(F.col("verdict.status")))
        return df.withColumn("verdict", held)

    done = verify.verify(rows, first, repair, recheck, cut, config.max_repairs)
    own = F.transform("verdict_issues", lambda i: F.struct(i["type"], F.lit("TEXT"), i["reason"], F.lit(None).cast("string"), F.lit(None).cast("string")).cast(samples.ISSUE))
    bad = F.col("outcome").isin("REGENERATE", "REJECTED")
    none = F.array().cast(f"array<{samples.ISSUE}>")
    return done.withColumn("issues", F.when(bad, own).when(F.col("outcome") == "VERIFYING", F.col("issues")).otherwise(none)).drop("verdict_issues")


def run(
    spark: SparkSession, config: RunConfig, cut: Step = shared.cut, attempt: Callable[[DataFrame, int], DataFrame] | None = None, taxonomy: DataFrame | None = None,
    judge: Step = offline_judge, repair: Step = offline_repair, limit: int | None = None, planned: DataFrame | None = None,
) -> Run:
    """Work off a run's tasks (planned, by plan_tasks over a table of slots, say; or plan_tasks of the configuration).

    attempt(packs, n) adds tagged_text, entities, input_tokens and output_tokens; the offline renderer by default. Each
    candidate is validated and, where a taxonomy gives its guidance, held against the examples. With quality_checks it is held
    against what the run accepted before (novelty_mode), then judged and repaired once. A failed attempt leads to the next
    with its reflection, max_regenerate_attempts times; a rejected task is replaced in its slot by a new one with another
    number, seed and frame, max_task_replacements times. limit: stop once so many (or batch_size, if less) are accepted."""
    attempt = attempt or (lambda packs, n: samples.render(packs, DOCUMENTS, config.structure, config.custom_instruction, _only(config)))
    extra = {"run_id": F.lit(config.run_name), "seed_attempt": F.lit(1), "seed_frame_id": F.lit(None).cast("string"), "status": F.lit("CREATED"), "parent_task_id": F.lit(None).cast("string"), "reflection": F.lit(None).cast(REFLECTION)}
    tasks = cut((planned or plan_tasks(spark, config)).withColumns(extra))
    names, last = tasks.columns, tasks.count()
    stride = last * (config.max_task_replacements + 1)  # numbers that tasks and their replacements can have
    asked = last if limit is None else min(limit, config.batch_size, last)
    kept: dict[str, DataFrame] = {}
    count = begun = 0
    while True:
        left = tasks if limit is None else cut(tasks.where(F.col("sequence_no") > begun).orderBy("sequence_no").limit(asked - count))
        begun = left.agg(F.max("sequence_no")).first()[0] or begun
        for turn in range(config.max_task_replacements + 1):
            lost = _attempts(left, names, config, cut, attempt, taxonomy, judge, repair, kept, stride)
            spent = lost.where(F.col("replacement_no") >= config.max_task_replacements)
            kept["lost"] = _add(kept.get("lost"), spent)
            new, _ = flow.replacements(lost.select(*names), last, config.max_task_replacements)
            fresh = {"context_frame_id": other_frame(config.random_seed, F.col("task_id")), "seed_attempt": F.lit(1), "seed_frame_id": F.lit(None).cast("string"), "reflection": F.lit(None).cast(REFLECTION)}
            left = cut(new.withColumns(fresh).select(*names))
            if not (more := left.count()):
                break
            kept["replaced"] = _add(kept.get("replaced"), left)
            last += more
        count = kept["accepted"].count()
        if limit is None or count >= asked or tasks.where(F.col("sequence_no") > begun).isEmpty():
            break
    accepted = kept["accepted"].withColumn("formatted", tags.format_spans(F.col("tagged_text"))).orderBy("slot_no", "replacement_no")
    every = tasks if "replaced" not in kept else tasks.unionByName(kept["replaced"])
    ends = accepted.select("task_id", F.lit("ACCEPTED").alias("end")).unionByName(kept["rejected"].select("task_id", F.lit("REJECTED").alias("end"))).unionByName(kept["waiting"].select("task_id", F.lit("VERIFYING").alias("end")))
    every = every.join(ends.groupBy("task_id").agg(F.min("end").alias("end")), "task_id", "left").withColumn("status", F.coalesce("end", "status")).drop("end").select(*names)
    open_ = count < asked and not kept["waiting"].isEmpty()
    status = "COMPLETED" if count >= config.num_samples else "RUNNING" if open_ or (limit is not None and kept["lost"].isEmpty()) else "FAILED"
    return Run(config, every, kept["packs"], kept["unfit"], kept["attempts"], accepted, kept["lost"], kept["waiting"], status)


def _attempts(tasks: DataFrame, names: list[str], config: RunConfig, cut: Step, attempt, taxonomy, judge: Step, repair: Step, kept: dict[str, DataFrame], stride: int) -> DataFrame:
    """Rejected last candidates of tasks; all else goes to kept."""
    lost, left, most = None, tasks, config.max_regenerate_attempts + 1

    def recheck(rows: DataFrame) -> DataFrame:
        rows = check(rows, config)
        return guard_imitation(rows) if taxonomy is not None else rows

    for n in range(1, most + 1):
        packs, refused, unfit = seed_rounds(left, config, cut, stride)
        kept["packs"] = _add(kept.get("packs"), packs.withColumn("attempt_no", F.lit(n)))
        kept["unfit"] = _add(kept.get("unfit"), refused.withColumn("attempt_no", F.lit(n)))
        rows = recheck(attempt(guided(packs, taxonomy, config), n).withColumn("attempt_no", F.lit(n)))
        rows = rows.withColumn("novelty", F.lit(None).cast("struct<max_similarity:double,nearest:array<string>,issues:array<struct<type:string,scope:string,label:string,value:string>>>"))
        if config.quality_checks:
            rows = guard_novelty(cut(rows), kept.get("accepted"), config)
        rows = rows.withColumn("route", flow.route(F.array_distinct(F.transform("issues", lambda i: i["type"])))["status"])
        rows = cut(rows.withColumn("step", flow.gate(F.col("route"), config.quality_checks)))
        plain = F.array().cast("array<string>")
        ends = F.when(F.col("step") == "ACCEPT", "PASS").when(F.col("step") == "REJECT", "REJECTED").otherwise("REGENERATE")
        done = rows.where("step in ('ACCEPT', 'REJECT', 'REGENERATE')").withColumns({"outcome": ends, "stages": plain})
        if config.quality_checks:
            done = cut(done.unionByName(judged(rows.where("step in ('JUDGE', 'REPAIR')"), config, judge, repair, recheck, cut).select(*done.columns)))
        kept["attempts"] = _add(kept.get("attempts"), done)
        kept["accepted"] = _add(kept.get("accepted"), done.where("outcome in ('PASS', 'FIXED')"))
        kept["waiting"] = _add(kept.get("waiting"), done.where("outcome = 'VERIFYING'"))
        final = done.where((F.col("outcome") == "REJECTED") | ((F.col("outcome") == "REGENERATE") & F.lit(n == most)))
        lost = _add(lost, final.select(*names, "attempt_no", "issues", "input_tokens", "output_tokens"))
        # a task that no draw gave a fit pack is rejected without a candidate
        hopeless = unfit.join(refused.where(F.col("seed_try") == config.max_seed_pack_attempts).select("task_id", F.col("pack_issues").alias("issues")), "task_id")
        lost = lost.unionByName(hopeless.select(*names, F.lit(n).alias("attempt_no"), "issues", F.lit(0).alias("input_tokens"), F.lit(0).alias("output_tokens")))
        left = cut(regenerate(done.where((F.col("outcome") == "REGENERATE") & F.lit(n < most)), config.random_seed).select(*names))
        if left.isEmpty():
            break
    kept["rejected"] = _add(kept.get("rejected"), lost)
    return lost


def resume(done: Run, judge: Step, repair: Step, cut: Step = shared.cut) -> DataFrame:
    """The waiting candidates of a run, judged again: with outcome, stages and issues as in its attempts."""
    rows = done.waiting.drop("outcome", "stages")
    return judged(rows, done.config, judge, repair, lambda r: check(r, done.config), cut)


def demo(**changes) -> RunConfig:
    """The configuration of the registered queries."""
    base = RunConfig(run_name="demo", num_samples=2000, focus_labels=["PERSON", "DATE", "TIME", "EMAIL", "PHONE", "ADDRESS", "MONEY", "CARD_NUMBER", "ORGANIZATION", "GENDER"], minimum_per_label=20, optional_constraint_distribution={"multi_sentence": 0.5, "abbreviation": 0.3, "numeric_noise": 0.2}, random_seed=174, frame_policy="balanced")
    return dataclasses.replace(base, **changes)
