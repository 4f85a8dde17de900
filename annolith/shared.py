"""The folder that driver and executors share, and tables written there to cut lineage between rounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session or its context. A local master, which has no other machine, may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='annolith-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Folders that this process has had written below the shared one.
written: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete what has been written to the shared folder so far, for when the results that read it are stored; how many folders went."""
    n = len(written)
    for path in written:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    written.clear()
    return n


#: Rows that a task makes, at most and about, where a table's rows make many each.
TASK_ROWS = 2_000_000


def tasks(spark: SparkSession, made: int) -> int:
    """Over how many tasks work on few bytes is dealt: over all cores, and no task makes more than about TASK_ROWS of the `made` rows or values."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism, -(-made // TASK_ROWS))


def spread(df: DataFrame, each: int = 1) -> DataFrame:
    """df, whose rows make `each` rows or values each, dealt over all cores and over as many tasks as keep each under TASK_ROWS. Short
    rows make much work here, and a file of them is read by few tasks."""
    return df.repartition(tasks(df.sparkSession, df.count() * each))


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back. The folder stays until release."""
    spark = df.sparkSession
    path = f"{folder(spark)}/round-{uuid.uuid4().hex}"
    written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
