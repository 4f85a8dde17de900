"""What a generating or judging model is given for a task: taxonomy guidance, feedback of failed attempts, JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions import rng

FEW_SHOT = 3
GROUPS = {"positive": "POSITIVE", "pure_negative": "PURE_NEGATIVE", "hard_negative": "HARD_NEGATIVE"}


def taxonomy_context(tasks: DataFrame, taxonomy: DataFrame, seed: int = 0) -> DataFrame:
    """tasks (task_id, focus_labels, sample_type) with context struct<focus, others> and missing array<string>.

    The first label gets definition, rules (one a line) and examples of the sample type, FEW_SHOT of them at most, drawn by
    (seed, task, label) and kept in their order; the others get no examples. Labels without an entry are in missing."""
    each = tasks.select("task_id", "sample_type", F.posexplode("focus_labels").alias("at", "code"))
    rows = each.join(taxonomy.select("code", "definition", "rules", "examples"), "code", "left")
    group = F.lit(None)
    for kind, name in GROUPS.items():
        group = F.when(F.col("sample_type") == kind, F.col(f"examples.{name}")).otherwise(group)
    numbered = F.transform(F.coalesce(group, F.array()), lambda e, i: F.struct(i.alias("i"), e.alias("e")))
    drawn = F.slice(F.array_sort(F.transform(numbered, lambda x: F.struct(rng.bits(seed, F.col("task_id"), F.col("code"), x["i"].cast("string")).alias("h"), x["i"].alias("i"), x["e"].alias("e")))), 1, FEW_SHOT)
    shots = F.transform(F.array_sort(F.transform(drawn, lambda x: F.struct(x["i"].alias("i"), x["e"].alias("e")))), lambda x: x["e"])
    guide = F.struct(F.col("code").alias("label"), "definition", F.array_join("rules", "\n").alias("rule"), F.when(F.col("at") == 0, shots).otherwise(F.filter(shots, lambda x: F.lit(False))).alias("examples"))
    packed = rows.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("at", guide.alias("guide"), F.col("rules").isNull().alias("absent")))).alias("g"))
    guides = F.transform("g", lambda x: x["guide"])
    context = F.struct(F.element_at(guides, 1).alias("focus"), F.slice(guides, F.lit(2), F.greatest(F.size(guides) - 1, F.lit(0))).alias("others"))
    missing = F.array_sort(F.array_distinct(F.transform(F.filter("g", lambda x: x["absent"]), lambda x: x["guide"]["label"])))
    return tasks.join(packed.select("task_id", context.alias("context"), missing.alias("missing")), "task_id", "left")


def reflection(issues: Column) -> Column:
    """struct<mandatory_repairs, must_not_repeat> of a failed attempt's issues."""
    return F.struct(
        F.transform(issues, lambda i: i["reason"]).alias("mandatory_repairs"),
        F.transform(issues, lambda i: F.struct(i["type"].alias("type"), i["reason"].alias("reason"))).alias("must_not_repeat"),
    )


def messages(system: str, **parts: Column) -> Column:
    """array<struct<role, content>>: the system text, and the parts as one JSON object; nulls are kept as null."""
    body = F.to_json(F.struct(*(c.alias(n) for n, c in parts.items())), {"ignoreNullFields": "false"})
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), body.alias("content")))
