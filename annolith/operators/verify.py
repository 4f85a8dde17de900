"""The judged path of a candidate: judge, one repair, checks that the repair kept what it had to, final judgement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions import tags

ISSUE = "struct<type:string,severity:string,field:string,reason:string>"


def _issue(kind: str, reason: Column, field: str = "candidate") -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit("high").alias("severity"), F.lit(field).alias("field"), reason.alias("reason")).cast(ISSUE)


def _empty() -> Column:
    return F.array().cast(f"array<{ISSUE}>")


def preservation_issues(text: Column, repaired: Column, entities: Column, positives: Column, decoys: Column) -> Column:
    """What a repair broke, as array of issues: each seed must stand once with its tag and be among the repaired entities; each
    look-alike must occur as often as before, at least once, untagged and not as an entity."""
    whole = lambda p: F.concat(F.lit("<"), p["label"], F.lit(">"), p["value"], F.lit("</"), p["label"], F.lit(">"))
    wrapped = tags.tagged_pairs(repaired, r"(?s)<([A-Za-z][A-Za-z0-9_]*)>([^<>]*)</[A-Za-z][A-Za-z0-9_]*>")

    def seed(p: Column) -> Column:
        listed = F.exists(entities, lambda e: (e["label"] == p["label"]) & (e["value"] == p["value"]))
        return F.when((tags.occurrences(repaired, whole(p)) != 1) | ~listed, _issue("REPAIR_CHANGED_POSITIVE_SEED", F.concat(F.lit("the repair changed the seed of "), p["label"])))

    def decoy(d: Column) -> Column:
        now = tags.occurrences(repaired, d["value"])
        lost = (now != tags.occurrences(text, d["value"])) | (now < 1)
        tagged = F.exists(wrapped, lambda w: w["value"] == d["value"]) | F.exists(entities, lambda e: e["value"] == d["value"])
        return F.when(lost | tagged, _issue("REPAIR_CHANGED_DECOY", F.concat(F.lit("the repair changed the look-alike "), d["value"])))

    return F.filter(F.concat(F.transform(positives, seed), F.transform(decoys, decoy)), lambda x: x.isNotNull())


def verify(candidates: DataFrame, judge: Callable[[DataFrame], DataFrame], repair: Callable[[DataFrame], DataFrame], recheck: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame], max_repairs: int = 1) -> DataFrame:
    """candidates with outcome (PASS, FIXED, REGENERATE, REJECTED, VERIFYING), its issues, and the stages that were called.

    VERIFYING: a call failed for reasons of infrastructure (verdict status ERROR, or a repair without text). The candidate is
    as it was and can be verified again; its attempt isn't used up.

    candidates: (tagged_text, entities, positives, decoys, ...). judge(rows) adds verdict struct<status, issues>; repair(rows)
    replaces tagged_text and entities; recheck(rows) adds issues, as the validator does. Each call's rows are written once
    by cut, so no model is asked twice. A FIXABLE first verdict without a repair left is REGENERATE; a final verdict other
    than PASS or REJECTED is REGENERATE. Rows that fail keep the original text."""
    names = candidates.columns
    first = cut(judge(candidates).withColumnRenamed("verdict", "initial"))
    fixable = F.col("initial.status") == "FIXABLE"
    settled = first.where(~fixable if max_repairs else F.lit(True))
    out = settled.select(*names, F.when(fixable, "REGENERATE").when(F.col("initial.status") == "ERROR", "VERIFYING").otherwise(F.col("initial.status")).alias("outcome"), F.col("initial.issues").alias("verdict_issues"), F.array(F.lit("judge")).alias("stages"))
    if not max_repairs:
        return out
    origin = F.struct(F.col("tagged_text"), F.col("entities")).alias("origin")
    fixed = cut(repair(first.where(fixable).select(*names, origin)))
    dead = fixed.where("tagged_text is null").select(*(F.col(f"origin.{n}").alias(n) if n in ("tagged_text", "entities") else F.col(n) for n in names), F.lit("VERIFYING").alias("outcome"), _empty().alias("verdict_issues"), F.array(F.lit("judge"), F.lit("repair")).alias("stages"))
    fixed = fixed.where("tagged_text is not null")
    kept = preservation_issues(F.col("origin.tagged_text"), F.col("tagged_text"), F.col("entities"), F.col("positives"), F.col("decoys"))
    checked = fixed.withColumn("broken", kept)
    rest = recheck(checked.drop("issues", "valid")) if "issues" in names else recheck(checked)
    again = F.transform("issues", lambda i: F.struct(i["type"].alias("type"), F.lit("high").alias("severity"), i["scope"].alias("field"), i["reason"].alias("reason")).cast(ISSUE))
    rest = cut(rest.withColumn("broken", F.when(F.size("broken") > 0, F.col("broken")).otherwise(again)))
    sound = F.size("broken") == 0
    back = [F.col(f"origin.{n}").alias(n) if n in ("tagged_text", "entities") else F.col(n) for n in names]
    failed = rest.where(~sound).select(*back, F.lit("REGENERATE").alias("outcome"), F.col("broken").alias("verdict_issues"), F.array(F.lit("judge"), F.lit("repair")).alias("stages"))
    final = cut(judge(rest.where(sound).drop("broken")).withColumnRenamed("verdict", "final"))
    status = F.col("final.status")
    good = status == "PASS"
    last = final.select(
        *(F.when(good, F.col(n)).otherwise(F.col(f"origin.{n}")).alias(n) if n in ("tagged_text", "entities") else F.col(n) for n in names),
        F.when(good, "FIXED").when(status == "REJECTED", "REJECTED").when(status == "ERROR", "VERIFYING").otherwise("REGENERATE").alias("outcome"),
        F.when(good, _empty()).otherwise(F.col("final.issues")).alias("verdict_issues"),
        F.array(F.lit("judge"), F.lit("repair"), F.lit("final_judge")).alias("stages"),
    )
    return out.unionByName(dead).unionByName(failed).unionByName(last)
