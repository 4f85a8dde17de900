"""Exact similarity join on word n-grams: documents whose shingle sets have a Jaccard similarity of num/den or more.

1. Every text becomes its sorted array of distinct 64-bit shingle hashes; equal sets collapse to one representative.
2. Candidates: two linked sets share one of their first n - ceil(t * n) + 1 shingles in any common total order. The order
   puts shingles that many documents hold last; their list is a bounded one and only orders, so it never drops a pair.
   Sets that share a shingle become candidates where their sizes and signatures allow a link: up to FEW of them pair by
   pair, up to CROWD in one pass over the group that keeps only its components. Larger crowds stay together untested.
3. Sets that are connected by such candidates form one tile; large ones are cut into size bands (linked sizes lie at
   most one band apart) and hashed parts of bounded size, and every pair of parts of equal or neighbouring bands is a tile.
4. In a tile, sets run in order of size against those within the size bound. A bitmap signature holds the parity of the
   shingles that hash to each bit, so every bit that differs costs a shingle that only one set has: an upper bound of the
   overlap is (|x| + |y| - bits that differ) / 2; only pairs that pass are intersected as sorted arrays. Pairs already
   connected are passed over, so a group of copies gives one edge a member and not all its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import arrow_batch, cut, groups, lean, runs, utf8
from annolith.llm.components import connected_components

CHUNK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)
SPACE = np.array([i == 32 or 9 <= i <= 13 for i in range(256)])
#: The list of frequent shingles: this many at most (1.5 MB), each in so many documents of a batch at least.
HOT_MOST, HOT_LEAST = 1 << 18, 4
#: Sets sharing a shingle up to which their pairs are listed, and up to which one task holds their signatures.
FEW, CROWD = 16, 4096
#: Bits of a signature (binary logarithms).
NARROWEST, WIDEST = 10, 17
#: A tile's bounds: sets, and shingles in them.
TILE_SETS, TILE_SHINGLES = 4096, 1 << 23
#: Representatives whose ids are broadcast to pick out their texts; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX2
    return h ^ (h >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, more than n of each; kept for runs of usual size only."""
    if _powers and n <= CHUNK:
        return _powers[0]
    up, down = np.full(max(n, CHUNK) + 1, BASE), np.full(max(n, CHUNK) + 1, UNBASE)
    up[0] = down[0] = 1
    found = np.cumprod(up, out=up), np.cumprod(down, out=down)
    if n <= CHUNK:
        _powers.append(found)
    return found


def shingles(data: np.ndarray, offsets: np.ndarray, words: int):
    """Sorted distinct shingle hashes of each row, in row order."""
    for a, b in runs(offsets, CHUNK):
        own = offsets[a : b + 1] - offsets[a]
        low = LOWER[data[offsets[a] : offsets[b]]]
        n = len(low)
        if not n:
            yield from (np.zeros(0, np.uint64) for _ in range(b - a))
            continue
        ink = ~SPACE[low]
        first, last = ink.copy(), ink.copy()
        first[1:] &= ~ink[:-1]
        last[:-1] &= ~ink[1:]
        edge = own[:-1][own[:-1] < n]
        first[edge] = ink[edge]
        edge = own[1:][own[1:] > 0] - 1
        last[edge] = ink[edge]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _power(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = _mix((total[ends] - total[starts]) * down[starts])
        bounds = np.searchsorted(starts, own)
        if len(h) >= words:
            g = h[: len(h) - words + 1].copy()
            for i in range(1, words):
                g = g * BASE + h[i : len(h) - words + 1 + i]
            g = _mix(g)
        for i in range(b - a):
            p, q = int(bounds[i]), int(bounds[i + 1])
            if q - p >= words:
                s = np.sort(g[p : q - words + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif q > p:  # too short: the whole sequence is the one shingle, apart from longer ones by its count
                x = np.array([q - p], np.uint64)
                for y in h[p:q]:
                    x = x * BASE + y
                yield _mix(x * MIX)
            else:
                yield np.zeros(0, np.uint64)


def _frequent(words: int):
    out = pa.schema([("shingle", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in runs(offsets, 32 * CHUNK):
                part = [s for s in shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words) if len(s)]
                if not part:
                    continue
                s = np.sort(np.concatenate(part))
                at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
                count = np.diff(np.concatenate((at, [len(s)])))
                keep = count >= HOT_LEAST
                yield arrow_batch(out, shingle=s[at[keep]].view(np.int64), docs=count[keep])

    return run


def frequent_shingles(docs: DataFrame, text_col: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The HOT_MOST most frequent shingles (sorted) and the binary logarithms of their counts, from all documents.

    A shingle is counted where a batch of documents holds it HOT_LEAST times; the list only orders shingles."""
    counts = docs.select(text_col).mapInArrow(lean(_frequent(words)), "shingle long, docs long")
    top = counts.groupBy("shingle").agg(F.sum("docs").alias("docs")).orderBy(F.desc("docs"), "shingle").limit(HOT_MOST).toPandas()
    keys = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log2(top["docs"].to_numpy(np.float64)[order]).astype(np.uint8)


def _sketches(words: int, num: int, den: int, hot):
    out = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("prefix", pa.list_(pa.int64())), ("mark", pa.binary())])

    def run(batches):
        keys, level = hot.value
        seen = np.zeros(1 << 20, bool)
        seen[(keys >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0)
            n, h1, h2, prefix, mark = [], [], [], [], []
            for s in shingles(data, offsets, words):
                p = len(s) - -(-num * len(s) // den) + 1 if len(s) else 0
                first = s[:p]
                if len(keys) and len(s):
                    maybe = np.flatnonzero(seen[(s >> np.uint64(44)).astype(np.int64)])
                    if len(maybe):
                        at = np.minimum(np.searchsorted(keys, s[maybe]), len(keys) - 1)
                        hit = keys[at] == s[maybe]
                        if hit.any():
                            rank = np.zeros(len(s), np.uint8)
                            rank[maybe[hit]] = level[at[hit]]
                            first = s[np.argsort(rank, kind="stable")[:p]]
                n.append(len(s))
                h1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                h2.append(int(_mix(s + BASE).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                prefix.append(first.view(np.int64))
                mark.append(signature(s, num, den).tobytes())
            lens = np.cumsum([0, *map(len, prefix)])
            lists = pa.ListArray.from_arrays(pa.array(lens, pa.int32()), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), lists, pa.array(mark, pa.binary())], schema=out)

    return run


def _sets(words: int):
    out = pa.schema([("rep", pa.int64()), ("grp", pa.int64()), ("big", pa.bool_()), ("n", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            s = list(shingles(data, offsets, words))
            yield arrow_batch(out, rep=batch.column("rep"), grp=batch.column("grp"), big=batch.column("big"), n=[len(x) for x in s], shingles=[x.tobytes() for x in s])

    return run


def signature(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Parity of the number of shingles at each bit, as 64-bit words.

    Linked sets differ in n * (den - num) / num shingles at most; unrelated ones in half of the bits, of which there are four times
    as many as that, within bounds. The low bits of a hash choose the place, so halves fold into a narrower signature by exclusive or."""
    width = min(WIDEST, max(NARROWEST, (4 * len(s) * (den - num) // num).bit_length()))
    count = np.bincount((s & np.uint64((1 << width) - 1)).astype(np.int64), minlength=1 << width)
    return np.packbits(count.astype(np.uint8) & 1).view(np.uint64)


def fold(marks: np.ndarray, words: int) -> np.ndarray:
    """Signatures (one a row) folded to a number of words."""
    while marks.shape[1] > words:
        half = marks.shape[1] // 2
        marks = marks[:, :half] ^ marks[:, half:]
    return marks


def _few(num: int, den: int):
    """Of pairs with sizes and signatures, those whose overlap can be large enough."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = batch.column("mark_a").to_pylist(), batch.column("mark_b").to_pylist()
            shapes: dict[tuple[int, int], list[int]] = {}
            for i in range(len(x)):
                shapes.setdefault((len(x[i]), len(y[i])), []).append(i)
            differ = np.zeros(len(x), np.int64)
            for (p, q), rows in shapes.items():
                words = min(p, q) // 8
                m, n = (fold(np.frombuffer(b"".join([z[i] for i in rows]), np.uint64).reshape(len(rows), -1), words) for z in (x, y))
                differ[rows] = np.bitwise_count(m ^ n).sum(axis=1, dtype=np.int64)
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = pa.array((both - differ) // 2 * (num + den) >= num * both)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], schema=out)

    return run


def _crowds(num: int, den: int):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for _, t in groups(batches, ["shingle"]):
            marks = [np.frombuffer(x, np.uint64) for x in t.column("mark").to_pylist()]
            if found := component_edges(t.column("rep").to_numpy().astype(np.int64), t.column("n").to_numpy().astype(np.int64), marks, num, den):
                yield arrow_batch(out, a=[x for x, _ in found], b=[x for _, x in found])

    return run


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def component_edges(ids: np.ndarray, n: np.ndarray, marks: list[np.ndarray], num: int, den: int, sets: list[np.ndarray] | None = None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(id, smallest id of its component) for every member but that one.

    Pairs link by their sets, or without sets where sizes and signatures allow it. side: only pairs of two sides count."""
    order = np.lexsort((ids, n))
    ids, n, marks = ids[order], n[order], [marks[i] for i in order]
    words = np.array([len(x) for x in marks])  # grows with the size, so a set meets only sets of as many words or more
    by = {w: (int(np.argmax(words >= w)), np.concatenate([fold(x[None, :], w) for x in marks[int(np.argmax(words >= w)) :]])) for w in np.unique(words).tolist()}
    side = None if side is None else side[order]
    part = np.unique(ids, return_inverse=True)[1]
    ends = np.searchsorted(n, n * den // num, "right")
    for i in range(len(ids)):
        if ends[i] <= i + 1:
            continue
        open_ = part[i + 1 : ends[i]] != part[i]
        if side is not None:
            open_ &= side[i + 1 : ends[i]] != side[i]
        j = np.flatnonzero(open_) + i + 1
        if not len(j):
            continue
        first, own = by[int(words[i])]
        differ = np.bitwise_count(own[j - first] ^ own[i - first]).sum(axis=1, dtype=np.int64)
        both = n[j] + n[i]
        for k in j[(both - differ) // 2 * (num + den) >= num * both].tolist():
            if part[k] != part[i] and (sets is None or common(sets[order[i]], sets[order[k]]) * (num + den) >= num * int(n[i] + n[k])):
                part[part == part[k]] = part[i]
    least: dict[int, int] = {}
    for x, p in zip(ids.tolist(), part.tolist(), strict=True):
        least[p] = min(x, least.get(p, x))
    return [(x, least[p]) for x, p in sorted(set(zip(ids.tolist(), part.tolist(), strict=True))) if x != least[p]]


def _tiles(num: int, den: int):
    out = pa.schema([("rep", pa.int64()), ("low", pa.int64()), ("big", pa.bool_())])

    def run(batches):
        for (_, lo, hi, big), t in groups(batches, ["grp", "lo", "hi", "big"]):
            ids = t.column("rep").to_numpy().astype(np.int64)
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("shingles")]
            side = t.column("side").to_numpy().astype(np.int64) if lo != hi else None
            n, marks = np.array([len(x) for x in sets], np.int64), [signature(x, num, den) for x in sets]
            if found := component_edges(ids, n, marks, num, den, sets, side):
                yield arrow_batch(out, rep=[x for x, _ in found], low=[x for _, x in found], big=[big] * len(found))

    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per input row: (id_col, n_shingles, component_id).

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles are `words` words; two documents link when
    den * |x & y| >= num * |x | y|. component_id is the smallest id reachable by links, the own one included. A text of
    fewer words is one shingle; a null, empty or blank text has none and links with nothing. Rows with equal ids are one
    node; a row without id stays in the result with a null component and links nothing. Other columns are ignored.
    Sets are compared by 64-bit shingle hashes.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    hot = spark.sparkContext.broadcast(frequent_shingles(own, "text", words))
    sig = cut(own.mapInArrow(lean(_sketches(words, num, den, hot)), "id long, n long, h1 long, h2 long, prefix array<long>, mark binary"), "sketches")
    real = sig.where((F.col("n") > 0) & F.col("id").isNotNull())
    reps = real.groupBy("h1", "h2").agg(F.min(F.struct("id", "n", "prefix", "mark")).alias("r")).select("r.*").withColumnRenamed("id", "rep")
    reps = cut(reps, "representatives")
    parts = cut(connected_components(_candidates(reps, num, den), "a", "b"), "candidates")
    parts = parts.union(parts.select(F.col("component").alias("node"), "component").distinct())
    members = parts.join(reps.select(F.col("rep").alias("node"), "n"), "node").groupBy(F.col("node").alias("rep")).agg(F.min("component").alias("grp"), F.max("n").alias("n"))
    linked = _linked(own, cut(members, "members"), words, num, den)
    classes = real.groupBy("h1", "h2").agg(F.min("id").alias("rep")).join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component"))
    nothing = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("h2"))
    rows = sig.select("id", "n", "h1", nothing.alias("h2")).join(classes, ["h1", "h2"], "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def _candidates(reps: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) over (rep, n, prefix, mark) whose components hold every linked pair."""
    held = reps.select("rep", "n", F.explode("prefix").alias("shingle"))
    # counted before the join, which splits a hot shingle's rows over tasks; a window would sort them all in one
    counts = held.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("rep").alias("pivot")).where("sets > 1")
    shared = cut(held.join(counts, "shingle"), "shared")
    lists = shared.where(F.col("sets") <= FEW).groupBy("shingle").agg(F.array_sort(F.collect_list(F.struct("n", "rep"))).alias("s"))
    pairs = lists.select(F.explode(F.expr(
        f"flatten(transform(s, (x, i) -> transform(filter(slice(s, i + 2, size(s)), y -> y.n * {num} <= x.n * {den}), y -> struct(least(x.rep, y.rep) as a, greatest(x.rep, y.rep) as b))))")).alias("p"))
    pairs = pairs.select("p.*").where("a < b").distinct()
    for c in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("mark").alias(f"mark_{c}")), c)
    few = pairs.select("a", "b", "n_a", "n_b", "mark_a", "mark_b").mapInArrow(lean(_few(num, den)), "a long, b long")
    crowd = shared.where((F.col("sets") > FEW) & (F.col("sets") <= CROWD)).select("shingle", "rep", "n").join(reps.select("rep", "mark"), "rep")
    crowd = crowd.repartition("shingle").sortWithinPartitions("shingle", "rep").mapInArrow(lean(_crowds(num, den)), "a long, b long")
    return few.union(crowd).union(shared.where(F.col("sets") > CROWD).select(F.col("rep").alias("a"), F.col("pivot").alias("b")))


def _linked(own: DataFrame, members: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(node, component) of the verified links among candidates (rep, grp, n)."""
    size = members.groupBy("grp").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    big = size.where((F.col("sets") > TILE_SETS) | (F.col("shingles") > TILE_SHINGLES)).select("grp", F.lit(True).alias("big"))
    members = members.join(big, "grp", "left").withColumn("big", F.coalesce("big", F.lit(False)))
    picked = members.select(F.col("rep").alias("id"), "rep", "grp", "big")
    count = members.count()
    picked = own.join(F.broadcast(picked) if count <= BROADCAST_ROWS else picked, "id")
    sets = picked.select("rep", "grp", "big", "text").mapInArrow(lean(_sets(words)), "rep long, grp long, big boolean, n long, shingles binary")
    band = F.floor(F.log(F.col("n")) / F.lit(math.log(den / num * 1.0001))).cast("int")
    sets = sets.withColumn("band", band)
    none = F.struct(F.lit(-1).alias("band"), F.lit(0).alias("part"))
    small = sets.where(~F.col("big")).select("grp", none.alias("lo"), none.alias("hi"), "big", "rep", "shingles", F.lit(0).alias("side"))
    if big.isEmpty():
        return _tiled(small, num, den).select(F.col("rep").alias("node"), F.col("low").alias("component"))
    cells = members.where("big").withColumn("band", band).groupBy("grp", "band").agg(
        F.ceil(F.greatest(F.count("*") / (TILE_SETS // 2), F.sum("n") / (TILE_SHINGLES // 2))).cast("int").alias("parts"))
    plan = cells.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("band", "parts"))).alias("plan"))
    mine = F.struct(F.col("band").alias("band"), F.expr("cast(pmod(xxhash64(rep), plan[band]) as int)").alias("part"))
    near = F.expr("flatten(transform(filter(array(band - 1, band, band + 1), b -> plan[b] is not null), b -> transform(sequence(0, plan[b] - 1), p -> struct(b as band, p as part))))")
    pairs = sets.where("big").join(plan, "grp").select("grp", "rep", "shingles", mine.alias("mine"), F.explode(near).alias("other"))
    large = pairs.select("grp", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), F.lit(True).alias("big"), "rep", "shingles", F.when(F.expr("mine <= other"), 0).otherwise(1).alias("side"))
    edges = cut(_tiled(small.union(large), num, den), "links")
    spread = connected_components(edges.where("big"), "rep", "low")
    return edges.where(~F.col("big")).select(F.col("rep").alias("node"), F.col("low").alias("component")).union(spread)


def _tiled(rows: DataFrame, num: int, den: int) -> DataFrame:
    rows = rows.withColumns({"lo": F.concat_ws(".", "lo.band", "lo.part"), "hi": F.concat_ws(".", "hi.band", "hi.part")})
    rows = rows.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi", "rep")
    return rows.mapInArrow(lean(_tiles(num, den)), "rep long, low long, big boolean")


#: The classes of the query's three-word shingles at a similarity of 90 in 100.
ORACLE_SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
     s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                          else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w),
     n as (select doc_id, len(s) as n from s),
     x as (select doc_id, unnest(s) as g from s),
     c as (select a.doc_id as a, b.doc_id as b, count(*) as c from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by all),
     l as (select a, b from c join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 90 * (na.n + nb.n - c)),
     e as (select a, b from l union all select b, a from l),
     r as (select doc_id as id, doc_id as root from n union select e.b, r.root from r join e on e.a = r.id where r.root < e.b)
select id as doc_id, n.n as n_shingles, min(root) as component_id from r join n on n.doc_id = r.id group by id, n.n
"""
