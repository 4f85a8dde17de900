"""Taxonomy and configuration readers, dataset and event writers."""

from __future__ import annotations

import dataclasses
import json
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.plans.planner import RunConfig

EXAMPLE = "array<struct<id:string,expected_tagged_text:string,rationale:string>>"
TAXONOMY = f"LABEL string, DEFINITION string, RULE array<string>, EXAMPLES struct<POSITIVE:{EXAMPLE},PURE_NEGATIVE:{EXAMPLE},HARD_NEGATIVE:{EXAMPLE}>"
ENVELOPE = "event_id string, event_type string, event_version int, occurred_at timestamp, correlation_id string, causation_id string, idempotency_key string, payload string, position long"
#: Folders of a batch of events: a run's are in one of them, so a batch of many runs stays at few files.
BUCKETS = 32


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(code, definition, rules, examples, errors) of a JSON array file; errors names every rule that an entry breaks."""
    rows = spark.read.schema(TAXONOMY).option("multiLine", True).json(path)
    groups = [F.col(f"EXAMPLES.{g}") for g in ("POSITIVE", "PURE_NEGATIVE", "HARD_NEGATIVE")]
    size = lambda g: F.coalesce(F.size(g), F.lit(0))
    errors = [
        F.when(F.col("LABEL").isNull() | (F.col("LABEL") != F.upper(F.trim("LABEL"))), "label is not upper case and trimmed"),
        *(F.when(size(g) < 3, "an example group has under three examples") for g in groups),
        *(F.when(F.size(F.array_distinct(F.transform(g, lambda e: e["id"]))) < size(g), "example ids repeat") for g in groups),
    ]
    rows = rows.withColumn("errors", F.array_distinct(F.filter(F.array(*errors), lambda e: e.isNotNull())))
    twice = rows.groupBy("LABEL").agg(F.count("*").alias("n")).where("n > 1").select("LABEL", F.lit(True).alias("twice"))
    rows = rows.join(twice, "LABEL", "left").withColumn("errors", F.when(F.col("twice"), F.array_append("errors", F.lit("label repeats"))).otherwise(F.col("errors")))
    return rows.select(F.col("LABEL").alias("code"), F.col("DEFINITION").alias("definition"), F.col("RULE").alias("rules"), F.col("EXAMPLES").alias("examples"), "errors")


def read_config(spark: SparkSession, path: str) -> RunConfig:
    """A run configuration from a JSON file of any file system that Spark reads."""
    return parse_config(spark.read.text(path, wholetext=True).first()[0])


def parse_config(text: str) -> RunConfig:
    """Unknown keys are an error; older spellings are taken over."""
    raw = json.loads(text.replace(" ", " ").replace(" ", " ").lstrip("﻿"))
    if "target_samples" in raw:
        raw.setdefault("num_samples", raw.pop("target_samples"))
    for key, kinds in (("difficulty", ("easy", "medium", "hard")), ("sample_type", ("positive", "pure_negative", "hard_negative"))):
        if key in raw:
            value = raw.pop(key)
            raw.setdefault(f"{key}_distribution", {k: float(k == value) for k in kinds})
    if "optional_constraints" in raw:
        raw.setdefault("optional_constraint_distribution", dict.fromkeys(raw.pop("optional_constraints"), 1.0))
    if isinstance(raw.get("max_entities"), int):
        raw["max_entities"] = dict.fromkeys(("easy", "medium", "hard"), raw["max_entities"])
    if "max_attempts" in raw:
        raw.setdefault("max_regenerate_attempts", raw.pop("max_attempts") - 1)
    if unknown := sorted(set(raw) - {f.name for f in dataclasses.fields(RunConfig)}):
        raise ValueError("unknown keys: " + ", ".join(unknown))
    return RunConfig(**raw)


def write_dataset(samples: DataFrame, path: str, name: str, partial: bool = False) -> str:
    """Samples (text, entities) as JSON lines below path, committed by Spark's job commit; the final write, once done, removes the partial one."""
    from annolith.functions.text import file_stem

    spark = samples.sparkSession
    stem = spark.range(1).select(file_stem(F.lit(name))).first()[0]
    target, other = (f"{path.rstrip('/')}/{stem}.{kind}" for kind in (("partial", "final") if partial else ("final", "partial")))
    samples.write.mode("overwrite").json(target)
    if not partial:
        old = spark._jvm.org.apache.hadoop.fs.Path(other)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return target


def _bucket(run: Column) -> Column:
    """The folder of a run's events: its bucket, by a hash of its name; events without run go with the run of an empty name."""
    return F.pmod(F.xxhash64(F.coalesce(run, F.lit(""))), F.lit(BUCKETS)).cast("int")


def append_events(events: DataFrame, path: str, batch: str) -> None:
    """Add a batch of events (columns of ENVELOPE) to the log below path. A batch that is written again, after a failure or a replay,
    takes its own place and adds nothing. Files lie by batch and bucket of runs: BUCKETS of them, however many runs there are."""
    target = f"{path.rstrip('/')}/batch={quote(batch, safe='')}"
    events.withColumn("bucket", _bucket(F.col("correlation_id"))).write.mode("overwrite").partitionBy("bucket").json(target)


def event_sink(path: str, name: str):
    """A function for foreachBatch that appends a stream's micro-batches: each by its number, so a repeated one adds nothing."""
    return lambda batch, n: append_events(batch, path, f"{name}-{n}")


def read_events(spark: SparkSession, path: str, correlation_id: str | None = None) -> DataFrame:
    """The log's events, each once by its key, those of a run (for which only its bucket's files are read) in order of causation."""
    rows = spark.read.schema(f"{ENVELOPE}, batch string, bucket int").json(path)
    if correlation_id is not None:
        rows = rows.where((F.col("bucket") == _bucket(F.lit(correlation_id))) & (F.coalesce("correlation_id", F.lit("")) == correlation_id))
    rows = rows.dropDuplicates(["idempotency_key"]).drop("batch", "bucket")
    return rows if correlation_id is None else rows.orderBy("position", "event_id")
