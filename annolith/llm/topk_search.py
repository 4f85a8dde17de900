"""Exact k nearest binary codes by incremental multi-index hashing.

A code is cut into segments of SEGMENT bits, each with its own table from segment value to codes. A query looks up, for
radius r = 0, 1, ..., segment after segment, all values at distance r from its own; every code that differs in d bits has a
segment that differs in d // segments bits at most, so after segment j of radius r all codes with distance up to
segments * r + j are verified. The search of a query ends once its kth distance is within that bound.

Equal codes are searched once: a code stands for its smallest k + 1 ids, and equal queries for one. Codes are dealt by a
hash into blocks of CODES_IN_BLOCK; a block's index is built once for each group of queries that it answers, and queries
pass by it in batches, so a task holds one block whatever their number. Queries are dealt into as few groups as give all
tasks work: rows shuffled are codes * groups + queries * blocks. The best k per query are merged over blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolith.llm.common import cut, lean

WORD, SEGMENT = 64, 16
#: Codes of a block (words of them, so that wide codes make smaller blocks), queries that are searched at once, least queries of a group.
CODES_IN_BLOCK, QUERIES_AT_ONCE, LEAST_GROUP = 1 << 20, 1 << 11, 1 << 12
#: Pairs of block and group that are aimed at where blocks alone are fewer.
MOST_TASKS = 4096


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, code): bit i of the code is set where component i is above 0; code: array of 64-bit words, without zero words at its end.

    A null or empty vector has no code and no row; null and NaN components give 0; a short vector is as one with zeros after it."""
    bit = lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.expr("1L"), i.cast("int"))).otherwise(F.expr("0L"))
    word = lambda w: F.aggregate(F.transform(F.slice(vector_col, (w * WORD + 1).cast("int"), F.lit(WORD)), bit), F.expr("0L"), lambda a, x: a.bitwiseOR(F.coalesce(x, F.expr("0L"))))
    words = F.transform(F.sequence(F.lit(0), F.floor((F.size(vector_col) - 1) / WORD).cast("int")), word)
    rows = vectors.where(F.size(vector_col) > 0).select(F.col(id_col).cast("long").alias("id"), words.alias("words"))
    last = F.aggregate(F.transform("words", lambda x, i: F.when(x != 0, i + 1).otherwise(1)), F.lit(1), lambda a, x: F.greatest(a, x))
    return rows.select("id", F.slice("words", F.lit(1), last).alias("code"))


def masks(bits: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << i for i in c) for c in combinations(range(bits), radius)], np.int64)


class MultiIndex:
    """codes: (codes, words) of unsigned 64-bit integers; counts: ids of each code."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        self.segments = codes.shape[1] * WORD // SEGMENT
        self.tables = []
        for s in range(self.segments):
            v = self.segment(codes, s)
            order = np.argsort(v, kind="stable").astype(np.int32)
            self.tables.append((order, np.searchsorted(v[order], np.arange((1 << SEGMENT) + 1)).astype(np.int32)))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        word, place = divmod(s * SEGMENT, WORD)
        return (codes[:, word] >> np.uint64(place) & np.uint64((1 << SEGMENT) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int):
        """(query, code, distance) rows that hold, for each query, every code up to its kth distance."""
        n, most = len(queries), self.segments * SEGMENT
        found = np.zeros((n, most + 1), np.int64)  # ids by distance
        todo, out = np.arange(n), []
        total = int(self.counts.sum())
        for radius in range(SEGMENT + 1):
            flips = masks(SEGMENT, radius)
            for s in range(self.segments):
                order, first = self.tables[s]
                step = max(1, (1 << 18) // len(flips))
                for part in (todo[i : i + step] for i in range(0, len(todo), step)):
                    probe = self.segment(queries[part], s)[:, None] ^ flips[None, :]
                    lo, size = first[probe].ravel(), (first[probe + 1] - first[probe]).ravel()
                    ends = np.cumsum(size)
                    # candidates in ranges of bounded number, so that crowded values cost time and not memory
                    cuts = np.append(np.searchsorted(ends, np.arange(0, int(ends[-1]), 1 << 19), "left"), len(ends)) if len(ends) else []
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        if a == b:
                            continue
                        q, c, d = self._meet(queries, np.repeat(part, len(flips))[a:b], lo[a:b], size[a:b], order, s, radius)
                        np.add.at(found, (q, d), self.counts[c])
                        # what can't be among the k nearest of all is of no use later on
                        enough = found.cumsum(axis=1) >= min(k, total)
                        near = (d <= np.argmax(enough, axis=1)[q]) | ~enough[q, -1]
                        out.append((q[near], c[near], d[near]))
                sure = self.segments * radius + s
                seen = found[todo].cumsum(axis=1)
                todo = todo[(seen[:, min(sure, most)] < k) & (seen[:, -1] < total)]
                if not len(todo):
                    break
            if not len(todo):
                break
        q, c, d = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
        kth = np.argmax(found.cumsum(axis=1) >= min(k, total), axis=1)
        keep = d <= kth[q]
        return q[keep], c[keep], d[keep]

    def _meet(self, queries: np.ndarray, own: np.ndarray, lo: np.ndarray, size: np.ndarray, order: np.ndarray, s: int, radius: int):
        """Codes that a look-up meets for the first time, with their distances."""
        q = np.repeat(own, size)
        ends = np.cumsum(size)
        c = order[np.repeat(lo - ends + size, size) + np.arange(len(q))].astype(np.int64)
        differ = self.codes[c] ^ queries[q]
        new = np.ones(len(q), bool)
        for t in range(self.segments):  # an earlier look-up has met the code if another segment is near enough
            if t != s:
                new &= np.bitwise_count(self.segment(differ, t)) > radius - (t > s)
        return q[new], c[new], np.bitwise_count(differ[new]).sum(axis=1, dtype=np.int64)


def _words(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of words, as wide as the widest or as asked; asked is never less than the widest."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, int(size.max(initial=1))) if width is None else width
    out = np.zeros((len(size), width), np.uint64)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return out


def _blocks(k: int):
    out = pa.schema([("query_code", pa.list_(pa.int64())), ("code", pa.list_(pa.int64())), ("distance", pa.int32())])

    def run(batches):
        key, codes, counts, raw, index = None, [], [], [], None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            block = np.stack([t.column(c).to_numpy() for c in ("code_block", "query_block", "is_query")], axis=1).astype(np.int64)
            edges = np.flatnonzero(np.append(True, (block[1:] != block[:-1]).any(axis=1))) if len(block) else []
            for a, b in zip(edges, [*edges[1:], len(block)], strict=True):
                part, now = t.slice(a, b - a), tuple(block[a, :2])
                if now != key:
                    key, codes, counts, index = now, [], [], None
                if not block[a, 2]:
                    codes.append(part.column("code").combine_chunks())
                    counts.append(part.column("n").to_numpy().astype(np.int64))
                    continue
                if not codes:
                    continue
                for i in range(0, part.num_rows, QUERIES_AT_ONCE):
                    asked = part.column("code").slice(i, QUERIES_AT_ONCE)
                    wide = pc.max(pc.list_value_length(asked)).as_py() or 1
                    if index is None or index.codes.shape[1] < wide:
                        raw = pa.concat_arrays([x for c in codes for x in (c.chunks if isinstance(c, pa.ChunkedArray) else [c])])
                        own = _words(raw)
                        index = MultiIndex(np.pad(own, ((0, 0), (0, max(0, wide - own.shape[1])))), np.concatenate(counts))
                    queries = _words(asked, index.codes.shape[1])
                    q, c, d = index.search(queries, k)
                    order = np.lexsort((c, d, q))
                    asked = pa.concat_arrays(asked.chunks) if isinstance(asked, pa.ChunkedArray) else asked
                    yield pa.RecordBatch.from_arrays([asked.take(pa.array(q[order])).cast(out.field(0).type), raw.take(pa.array(c[order])).cast(out.field(1).type), pa.array(d[order], pa.int32())], schema=out)

    return run


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows of codes (id, code) nearest to each row of queries, in order of
    distance and id, the row with the query's own id left out. Fewer rows only where the table has fewer.

    code: array of 64-bit words, missing words at the end are zeros. Rows without id or code are left out; repeated rows count
    once; other columns are ignored. An empty side gives no rows."""
    real = codes.where("id is not null and code is not null").select("id", "code").distinct()
    asked = cut(queries.where("id is not null and code is not null").select("id", "code").distinct(), "queries")
    ranked = real.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    kept = cut(ranked.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    wanted = asked.select("code").distinct()
    words = kept.agg(F.sum(F.greatest(F.size("code"), F.lit(1)))).first()[0] or 0
    n_codes = max(1, -(-words // CODES_IN_BLOCK))
    n_queries = max(1, min(-(-wanted.count() // LEAST_GROUP), MOST_TASKS // n_codes))
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    mine = lambda n: F.expr(f"pmod(xxhash64(code), {n})")
    left = kept.select("code", F.size("ids").cast("long").alias("n"), F.lit(0).alias("is_query"), mine(n_codes).alias("code_block"), every(n_queries).alias("query_block"))
    right = wanted.select("code", F.lit(0).cast("long").alias("n"), F.lit(1).alias("is_query"), every(n_codes).alias("code_block"), mine(n_queries).alias("query_block"))
    rows = left.unionByName(right).repartition(min(n_codes * n_queries, MOST_TASKS), "code_block", "query_block").sortWithinPartitions("code_block", "query_block", "is_query", "code")
    near = rows.mapInArrow(lean(_blocks(k + 1)), "query_code array<long>, code array<long>, distance int")
    best = near.join(kept, "code").select("query_code", "distance", F.explode("ids").alias("neighbor_id"))
    order = Window.partitionBy("query_code").orderBy("distance", "neighbor_id")
    best = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    lists = best.groupBy("query_code").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near"))
    rows = asked.join(lists, asked["code"] == lists["query_code"]).select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("near", lambda x: x["neighbor_id"] != F.col("id")), 1, k)).alias("r", "x"))
    return rows.select("query_id", (F.col("r") + 1).alias("rank"), F.col("x.neighbor_id").alias("neighbor_id"), F.col("x.distance").alias("distance"))


def embedding_top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 10) -> DataFrame:
    """top_k of the vectors' sign codes; queries are the rows whose id is divisible by `every`."""
    codes = sign_codes(vectors, id_col, vector_col)
    return top_k(codes, codes.where(F.col("id") % every == 0), k)


ORACLE_SQL = """
with q as (select distinct vec_id, embedding from embeddings where vec_id % 20 = 0 and len(embedding) > 0),
     pairs as (select q.vec_id as query_id, e.vec_id as neighbor_id,
                      len(list_filter(range(1, len(e.embedding) + 1), lambda i: (e.embedding[i] > 0) <> (q.embedding[i] > 0))) as distance
               from q, (select distinct vec_id, embedding from embeddings where len(embedding) > 0) e where e.vec_id <> q.vec_id),
     ranked as (select *, row_number() over (partition by query_id order by distance, neighbor_id) as r from pairs)
select query_id, cast(r as integer) as rank, neighbor_id, cast(distance as integer) as distance from ranked where r <= 10
"""
