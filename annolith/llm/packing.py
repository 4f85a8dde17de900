"""Packing token sequences of documents into training sequences of a fixed capacity by the sum-of-squares rule.

Every document is tokenized, ended by one id and, only where it is longer than the capacity, cut into pieces. Pieces are
dealt by a hash into shards of about SHARD pieces; each shard is packed by itself, longest pieces first, so that shards run
in parallel and the loss is at most about one sequence a shard. A piece goes where the sum over all gaps g of
(open sequences with gap g)^2 becomes smallest; of equal choices the smallest gap wins. The rule keeps sequences of
many gaps open, so each shard ends with passes that take sequences with gaps apart (all of them, then the emptiest half and
quarter) and place their pieces anew, best fit first; a pass is kept if fewer sequences result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from annolith.llm.common import arrow_batch, groups, lean, utf8
from annolith.llm.segments import encoder, forget

SHARD = 16_384
SHARD_KEY = "_pack_shard"


def _pieces(path: str, end_id: int, capacity: int, keep_ids: bool):
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)
    end = np.array([end_id], np.uint32)

    def run(batches):
        library = encoder(path)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for a, b, ids, at in library.encode(*utf8(batch.column(1))):
                rows: dict[str, list] = {f.name: [] for f in out}
                for i in range(b - a):
                    own = np.concatenate((ids[at[i] : at[i + 1]], end))
                    for k in range(0, len(own), capacity):
                        part = own[k : k + capacity].astype("<u4").tobytes()
                        for name, v in zip(rows, (docs[a + i], k // capacity, k, len(part) // 4, zlib.crc32(part), part), strict=False):
                            rows[name].append(v)
                yield arrow_batch(out, **rows)

    return run


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 and, if asked for, ids: little-endian unsigned 32-bit) of each piece of each row.

    A null or empty text is one piece of the end id alone; rows without id and repeated rows are encoded each; other columns
    are ignored; no rows give none."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(lean(_pieces(path, end_id, capacity, keep_ids), forget), schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence (0, 1, ...) of each length; lengths are 1 to capacity, and are placed longest first."""
    order = np.argsort(-lengths, kind="stable")
    where = np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    for i in order.tolist():
        s = int(lengths[i])
        if s == capacity:
            where[i] = len(gap_of)
            gap_of.append(0)
            continue
        own = count[s:]
        change = np.where(own > 0, 2 * (count[: len(own)] - own + 1), np.iinfo(np.int64).max)
        if own[0] > 0:
            change[0] = 1 - 2 * own[0]  # the sequence becomes full: no gap is left to count
        best = int(change.argmin())
        if own[best] > 0 and change[best] <= 2 * count[capacity - s] + 1:
            g = s + best
            b = open_[g].pop()
            count[g] -= 1
        else:
            g, b = capacity, len(gap_of)
            gap_of.append(capacity)
        where[i] = b
        gap_of[b] = g = g - s
        if g:
            count[g] += 1
            open_[g].append(b)
    return _dissolve(lengths, where, np.array(gap_of, np.int64), capacity)


def _dissolve(lengths: np.ndarray, where: np.ndarray, gap: np.ndarray, capacity: int) -> np.ndarray:
    """Take the emptiest sequences apart, as many as their gaps add up to and some more, and fit their pieces best-fit decreasing; kept if fewer sequences result."""
    best = where
    spare = int(gap.sum())
    if spare < capacity:
        return best
    ranked = np.argsort(-gap, kind="stable")
    for share in (1.0, 0.5, 0.25):
        open_count = int((gap > 0).sum())
        k = max(2, int(open_count * share))
        loose = ranked[:k]
        taken = np.zeros(len(gap), bool)
        taken[loose] = True
        mine = np.flatnonzero(taken[best])
        mine = mine[np.argsort(-lengths[mine], kind="stable")]
        slots: dict[int, list[int]] = {}
        free = np.zeros(capacity + 1, bool)
        for b in np.flatnonzero((gap > 0) & ~taken).tolist():
            slots.setdefault(int(gap[b]), []).append(b)
            free[gap[b]] = True
        trial, unused, used = best.copy(), loose.tolist()[::-1], 0
        for i in mine.tolist():
            s = int(lengths[i])
            fit = s + int(free[s:].argmax())
            if free[fit]:
                b = slots[fit].pop()
                free[fit] = bool(slots[fit])
            else:
                fit, b = capacity, unused.pop() if unused else len(gap) + used
                used += 1
            trial[i] = b
            if fit > s:
                slots.setdefault(fit - s, []).append(b)
                free[fit - s] = True
        if len(np.unique(trial)) < len(np.unique(best)):
            best = np.unique(trial, return_inverse=True)[1].astype(np.int64)
            gap = capacity - np.bincount(best, lengths.astype(np.float64)).astype(np.int64)
            ranked = np.argsort(-gap, kind="stable")
    return np.unique(best, return_inverse=True)[1].astype(np.int64)


def _packed(capacity: int, names: list[str], schema: pa.Schema):
    def run(batches):
        for (shard,), t in groups(batches, [SHARD_KEY]):
            lengths = t.column("length").to_numpy().astype(np.int64)
            where = sum_of_squares(lengths, capacity)
            order = np.argsort(where, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.concatenate(([True], np.diff(where[order]) > 0))
            offset = np.empty(len(where), np.int64)
            offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
            got = t.select(names).append_column("sequence_id", pa.array((shard << 32) + where)).append_column("offset", pa.array(offset))
            yield from got.cast(schema).combine_chunks().to_batches()

    return run


def pack(pieces: DataFrame, capacity: int = 4096, shard: int = SHARD) -> DataFrame:
    """pieces with sequence_id and offset, one row per row of pieces (its length is 1 to capacity).

    Needs doc_id, piece and length; other columns pass through, but for columns sequence_id and offset, which the result's
    own replace. Placement depends on the rows alone, not on their order:
    a shard's rows are sorted by length, doc_id and piece. No rows give no rows."""
    n = max(1, -(-pieces.count() // shard))
    pieces = pieces.drop("sequence_id", "offset")
    schema = StructType(list(pieces.schema)).add("sequence_id", "long").add("offset", "long")
    rows = pieces.withColumn(SHARD_KEY, F.expr(f"pmod(xxhash64(doc_id, piece, length), {n})"))
    rows = rows.repartition(SHARD_KEY).sortWithinPartitions(SHARD_KEY, F.desc("length"), "doc_id", "piece")
    return rows.mapInArrow(lean(_packed(capacity, list(pieces.columns), to_arrow_schema(schema))), schema)
