"""Event streams: idempotent delivery and windowed counts. The input is any streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(events: DataFrame, key: str = "idempotency_key", time: str = "occurred_at", late: str = "1 hour") -> DataFrame:
    """Each key once within the time that late events may take."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts(events: DataFrame, time: str = "occurred_at", kind: str = "event_type", width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window_start, kind, n) of tumbling windows; works on batches too."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")
