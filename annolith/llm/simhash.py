"""SimHash fingerprints of whole texts and the groups that fingerprints of nearly equal bits form.

1. A fingerprint bit is set where more than half of a text's shingle hashes (XXH64, repeats included) have it.
2. Equal fingerprints are one node, so copies of a text cost one row each and never a pair.
3. Multi-index hashing for a distance of 2: of the two 32-bit segments of linked fingerprints, either the first differs in
   one bit at most or the second in none. So a fingerprint lies in the tables of both segments, and looks up the ball of
   radius 1 around its first one; of two that differ in one bit of it, the one that lacks the bit does so.
4. A value that more than CROWD fingerprints share is cut further by the halves of the other segment, in the same manner:
   its tables then hold 65,536 fingerprints at most, whatever the number of documents.
5. Look-ups meet their table's rows in Arrow tasks, where complete distances are verified. Rows of a table that link give
   the edges of a spanning star, a look-up one edge for each star that it touches, so a crowd gives no pairs.
6. Components of these edges by alternating star joins.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import cut, lean, utf8
from annolith.llm.components import connected_components

#: Bytes of a text that are hashed at once.
CHUNK = 1 << 20
SEED = 42
DISTANCE = 2
#: Fingerprints of one segment value that stay one table.
CROWD = 4096
#: Crowded values that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _spans(text: bytes, size: int):
    """Lists of lower-cased words, each the last size - 1 words of the one before put first."""
    carry, at = [], 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        words = carry + text[at:end].lower().split()
        yield words
        carry, at = words[len(words) - size + 1 :] if len(words) >= size else words, end


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bit i is set where more than half of the shingles' hashes have it; a text of fewer words is one shingle, without words 0."""
    count, n, words = np.zeros(64, np.int64), 0, []
    for words in _spans(text, size):
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.append(0, ends[:-1] + 1)[: len(words) - size + 1].tolist()
            digest = xxhash.xxh64_digest
            raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)])
            count += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(starts)
    if not n and words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def _fingerprints(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        found = np.array([fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def near(table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with asked[i] and table[j], distinct sorted fingerprints, at a distance of DISTANCE or less.

    Either every pair is compared, or the ball around each asked one is looked up, in the bits in which the table's rows
    differ at all: whichever takes fewer steps."""
    vary = np.bitwise_or.reduce(table ^ table[0])
    fixed = np.bitwise_count((asked ^ table[0]) & ~vary).astype(np.int64)
    some = np.flatnonzero(fixed <= DISTANCE)
    own = BITS[(vary & BITS) != 0]
    flips = [np.bitwise_or.reduce(c) if c else np.uint64(0) for r in range(DISTANCE + 1) for c in combinations(own, r)] if len(own) ** 2 < 40 * len(table) else None
    i, j = [], []
    if flips is None or len(table) < 20 * len(flips):
        step = max(1, (1 << 22) // len(table))
        for a in range(0, len(some), step):
            p, q = np.nonzero(np.bitwise_count(asked[some[a : a + step], None] ^ table[None, :]) <= DISTANCE)
            i.append(some[a + p])
            j.append(q)
    else:
        base = (asked & vary) | (table[0] & ~vary)
        for flip in flips:
            rows = some[fixed[some] + int(np.bitwise_count(flip)) <= DISTANCE]
            at = np.minimum(np.searchsorted(table, base[rows] ^ flip), len(table) - 1)
            hit = table[at] == base[rows] ^ flip
            i.append(rows[hit])
            j.append(at[hit])
    return (np.concatenate(i), np.concatenate(j)) if i else (np.zeros(0, np.int64),) * 2


def stars(table: np.ndarray) -> np.ndarray:
    """For each row of a sorted table the place of the smallest row that it is connected to by links within the table."""
    label = np.arange(len(table))
    if len(table) < 2:
        return label
    i, j = near(table, table)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _links(batches):
    """Edges among rows sorted by key and then tables before look-ups."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    key, table, label = None, np.zeros(0, np.uint64), None

    def edges(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=out)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("segment", "value", "half", "part")], axis=1)
        probe = batch.column("probe").to_numpy().astype(np.int64)
        fp = batch.column("fp").to_numpy().view(np.uint64)
        begins = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        rows, asks = np.diff(np.append(begins, len(keys))), np.add.reduceat(probe, begins)
        wanted = (rows - asks >= 2) | ((rows > asks) & (asks >= 1))
        wanted[[0, -1]] = True  # they may go on from the batch before or into the next
        for g in np.flatnonzero(wanted).tolist():
            mine, last = tuple(keys[begins[g]]), g == len(begins) - 1
            part, n = fp[begins[g] : begins[g] + rows[g]], int(rows[g] - asks[g])
            if mine != key:
                if label is None and len(table) > 1:
                    yield from _star_edges(table, stars(np.sort(table)), edges)
                key, table, label = mine, part[:n], None
            elif n:
                table = np.concatenate([table, part[:n]])
            if len(table) and (asks[g] or not last):
                if label is None:
                    table = np.sort(table)
                    label = stars(table)
                    yield from _star_edges(table, label, edges)
                if asks[g]:
                    asked = part[n:]
                    i, j = near(table, asked)
                    if len(i):
                        pair = np.unique(np.stack([i, label[j]], axis=1), axis=0)
                        yield edges(asked[pair[:, 0]], table[pair[:, 1]])
    if label is None and len(table) > 1:
        yield from _star_edges(table, stars(np.sort(table)), edges)


def _star_edges(table, label, edges):
    table = np.sort(table)
    far = np.flatnonzero(label != np.arange(len(table)))
    if len(far):
        yield edges(table[far], table[label[far]])


def _ups(c, bits: int):
    """The values that have one bit more than c, which has `bits` bits."""
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: c.bitwiseOR(F.call_function("shiftleft", F.expr("1L"), i))), lambda x: x != c)


def _keys(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(segment, value, half, part, probe, fp): where each fingerprint lies and where it looks."""
    low = F.col("fp").bitwiseAND(F.expr("4294967295L"))
    high = F.shiftrightunsigned("fp", 32)
    place = lambda s, v, p: F.struct(F.lit(s).alias("segment"), v.alias("value"), F.lit(p).alias("probe"))
    spots = F.concat(F.array(place(0, low, 0), place(1, high, 0)), F.transform(_ups(low, 32), lambda v: place(0, v, 1)))
    rows = fps.select("fp", F.explode(spots).alias("k")).select("fp", "k.*")
    tables = fps.select(F.explode(F.array(place(0, low, 0), place(1, high, 0))).alias("k")).select("k.segment", "k.value")
    crowds = cut(tables.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("segment", "value", F.lit(True).alias("crowded")), "crowds")
    none = F.struct(F.lit(-1).alias("half"), F.expr("-1L").alias("part"), F.lit(0).alias("ask"))
    n = crowds.count()
    if not n:
        return rows.select("segment", "value", F.lit(-1).alias("half"), F.expr("-1L").alias("part"), "probe", "fp")
    rows = rows.join(F.broadcast(crowds) if n <= BROADCAST_ROWS else crowds, ["segment", "value"], "left")
    other = F.when(F.col("segment") == 0, high).otherwise(low)
    a, b = other.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(other, 16)
    spot = lambda h, v, p: F.struct(F.lit(h).alias("half"), v.alias("part"), F.lit(p).alias("ask"))
    both = F.array(spot(0, a, 0), spot(1, b, 0))
    finer = F.when(F.col("probe") == 1, both).otherwise(F.concat(both, F.transform(_ups(a, 16), lambda v: spot(0, v, 1))))
    rows = rows.withColumn("k", F.explode(F.when(F.col("crowded"), finer).otherwise(F.array(none))))
    return rows.select("segment", "value", "k.half", "k.part", F.greatest("probe", "k.ask").alias("probe"), "fp")


def fingerprint_links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) over distinct fingerprints (fp) whose components are those of all pairs that differ in DISTANCE bits or fewer."""
    keys = ["segment", "value", "half", "part"]
    rows = _keys(fps, crowd).repartition(*keys).sortWithinPartitions(*keys, "probe")
    return rows.mapInArrow(lean(_links), "a long, b long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per input row: (id_col, fingerprint, component_id).

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles are three words, repeats count. fingerprint: 16
    lower-case hexadecimal digits; of null, empty and blank texts it is zero, and they link like any others. component_id is
    the smallest id of the rows whose fingerprints are connected by links; a row without id stays, takes part in links, and
    has a null component only where no row has an id. Repeated rows stay repeated; other columns are ignored."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = cut(own.mapInArrow(lean(_fingerprints), "id long, fp long"), "fingerprints")
    fps = cut(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    joined = connected_components(fingerprint_links(fps.select("fp"), crowd), "a", "b")
    nodes = fps.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("top"))
    tops = nodes.groupBy("top").agg(F.min("low").alias("component_id"))
    classes = nodes.join(tops, "top").select("fp", "component_id")
    found = rows.join(classes, "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
