"""Shared helpers: the cluster's shared folder, cutting lineage, Arrow column access, contiguous groups."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.shared import written


#: Bytes of one Arrow batch, so that a Python worker's memory doesn't follow the length of texts.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share: spark.checkpoint.dir. A local master, which has no other machine, may go without."""
    bound_batches(spark)
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="annolith-")
        spark.conf.set("spark.checkpoint.dir", f"file://{found}")
    return (found if "://" in found else f"file://{found}").rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name below shared_dir, which annolith.shared.release deletes once results are stored."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    written.append(path)
    return path


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive any executor."""
    spark, path = df.sparkSession, scratch(df.sparkSession, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's offsets (n + 1); a null row is empty."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def runs(offsets: np.ndarray, most: int):
    """Row ranges (a, b) of about `most` bytes each; a longer row is a range by itself."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def groups(batches, keys: list[str]):
    """Tables of the rows of one key each, from batches in which a key's rows are contiguous."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        cols = [t.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        a = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[a]:
                if held and rows[a] != last:
                    yield last, pa.concat_tables(held)
                    held = []
                last = rows[a]
                held.append(t.slice(a, i - a))
                a = i
    if held:
        yield last, pa.concat_tables(held)


def arrow_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def _trim() -> None:
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lean(run, *caches):
    """run for mapInArrow, giving a worker's memory back at the end of each task; caches: functions that drop what a task kept."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            for drop in caches:
                drop()
            pa.default_memory_pool().release_unused()
            _trim()

    return task


def is_held_out(doc_id, folds: int = 5):
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds) == 0
