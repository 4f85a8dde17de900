"""Prefix trie of conversations, built by distributed MSD radix partitioning and finished by multikey quicksort.

1. A turn is known by the MD5 of its role and text and gets an id from a dictionary of distinct turns; texts are read once
   and never move. Turns are numbered within their conversation from a range partitioning, so that a conversation of any
   length is dealt over tasks: places in a partition plus the rows of the partitions before.
2. Equal conversations are one sequence with a count (copies cost one row each).
3. A bucket is the sequences that share a prefix. From the root, buckets are split by the id of the next turn; one of more
   than LOCAL turns is split again, at the first place where its sequences differ, and the nodes up to there, the same for
   all of them, are told by their bucket. A sequence alone in its bucket is a path, whose nodes are its rows.
4. Buckets of LOCAL turns or fewer meet in one task each, where multikey quicksort orders the sequences and its recursion
   emits the nodes with the sums of their subtrees.
5. Sums of the split buckets are added upwards, one level of splits after another.

A node is named by its depth and its smallest conversation. Every level is a table in the shared folder; only numbers of
buckets go to the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annolith.llm.common import cut, lean

#: Turns of a bucket that one task finishes.
LOCAL = 4096
#: Conversations are rebuilt in families of so many, by up to HEADS - 1 of the first one's turns.
FAMILY, HEADS = 5, 9
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_seq long"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv, pos, id, bytes): turns in order from 1, null first; turns of equal number in the order of their MD5. Rows without
    conv_id are left out; null role or text is empty; id: the turn's place in the dictionary of distinct (role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    rows = cut(rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "mark").withColumn("part", F.spark_partition_id()), "turns")
    # of the conversations of a partition only one can have begun before it, so there are no more rows of these than partitions
    parts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = parts.withColumn("before", F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")).where("before > 0").select("conv", "part", "before")
    place = F.row_number().over(Window.partitionBy("part", "conv").orderBy(F.col("turn").asc_nulls_first(), "mark"))
    placed = rows.withColumn("place", place).join(F.broadcast(before), ["conv", "part"], "left").select("conv", (F.col("place") + F.coalesce("before", F.expr("0L"))).alias("pos"), "mark", "bytes")
    words = cut(rows.select("mark").distinct().withColumn("id", F.monotonically_increasing_id()), "dictionary")
    return placed.join(words, "mark").select("conv", "pos", "id", "bytes")


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len) and their turns (conv, pos, id, bytes), rebuilt: the first h turns of conversation
    conv - conv % FAMILY (all if fewer, none if absent), then the own ones after the first h; h = head_length(conv). The remainder of a negative
    conv is negative, as in SQL."""
    lens = cut(turns.groupBy("conv").agg(F.max("pos").alias("own")), "lengths")
    base = F.col("conv") - F.col("conv") % FAMILY
    heads = lens.select("conv", base.alias("base"), "own", head_length(F.col("conv")).alias("h"))
    heads = heads.join(lens.select(F.col("conv").alias("base"), F.col("own").alias("there")), "base", "left")
    heads = heads.select("conv", "base", "own", "h", F.least("h", F.coalesce("there", F.expr("0L"))).alias("head"))
    late = heads.where((F.col("head") < F.col("h")) & (F.col("own") > F.col("h"))).select("conv", (F.col("h") - F.col("head")).alias("shift"))
    own = turns.where(F.col("pos") > head_length(F.col("conv"))).join(late, "conv", "left")
    own = own.select("conv", (F.col("pos") - F.coalesce("shift", F.expr("0L"))).alias("pos"), "id", "bytes")
    first = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS)).select(F.col("conv").alias("base"), "pos", "id", "bytes")
    copied = heads.select("conv", "base", "h").join(first, "base").where(F.col("pos") <= F.col("h")).select("conv", "pos", "id", "bytes")
    length = F.col("head") + F.greatest(F.col("own") - F.col("h"), F.expr("0L"))
    return heads.select("conv", length.alias("len")), copied.unionByName(own)


def sequences(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct sequences (seq, len, n), seq being the smallest conversation, their rows (seq, pos, id, bytes), and (seq, ends)
    of the conversations of each. Sequences are told apart by 128 bits over places and ids, and their lengths."""
    turns = cut(turns, "rebuilt")
    marks = turns.groupBy("conv").agg(F.bit_xor(F.xxhash64("pos", "id")).alias("x1"), F.bit_xor(F.xxhash64("id", F.lit("turn"), "pos")).alias("x2"))
    convs = cut(convs.join(marks, "conv", "left").select("conv", "len", *(F.coalesce(x, F.expr("0L")).alias(x) for x in ("x1", "x2"))), "marks")
    seqs = cut(convs.groupBy("len", "x1", "x2").agg(F.min("conv").alias("seq"), F.count("*").alias("n")), "sequences")
    rows = turns.join(seqs.select(F.col("seq").alias("conv")), "conv").withColumnRenamed("conv", "seq")
    many = convs.join(seqs.where("n > 1"), ["len", "x1", "x2"]).select("seq", "conv")
    many = many.repartition("seq").sortWithinPartitions("seq", "conv").mapInArrow(lean(_digests), "seq long, ends string")
    ends = seqs.where("n = 1").select("seq", F.sha2(F.col("seq").cast("string").cast("binary"), 256).alias("ends")).unionByName(many)
    return seqs.select("seq", "len", "n"), cut(rows, "rows"), ends


def _digests(batches):
    """SHA-256 of each sequence's conversations, which come in order; a digest is fed as rows pass, whatever their number."""
    key, digest = None, None
    for batch in batches:
        seq, conv = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begins = np.flatnonzero(np.append(True, seq[1:] != seq[:-1])) if len(seq) else np.zeros(0, np.int64)
        done = []
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(seq)], strict=False):
            text = ",".join(map(str, conv[a:b].tolist())).encode()
            if seq[a] == key:
                digest.update(b"," + text)
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = int(seq[a]), hashlib.sha256(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done])], names=["seq", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=["seq", "ends"])


def multikey_nodes(ids: list[list[int]], sizes: list[list[int]], seqs: list[int], counts: list[int], top: int, parent: int) -> list[tuple]:
    """Nodes of the trie of distinct sequences that share their first id, whose depth is `top`, below node `parent`.

    Each row: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, end_seq. Three-way radix quicksort:
    the sequences of a node are parted by the id at the node's depth into smaller, equal and larger ones; equal ones are a
    child, whose recursion gives its node, and the others are parted at the same place."""
    nodes: list[tuple] = []

    def node(mine: list[int], k: int, above: int) -> tuple[int, int]:
        """Emit the node of the sequences `mine`, equal in the first k ids, and all below it; (leaves, saved tokens)."""
        conv, n = min(seqs[i] for i in mine), sum(counts[i] for i in mine)
        first, some = k, ids[mine[0]]
        # down the chain of nodes that all of them share
        while len(mine) > 1 and all(len(ids[i]) > k for i in mine) and all(ids[i][k] == some[k] for i in mine[1:]):
            k += 1
        ends, leaves, saved, children = None, 0, 0, 0
        if len(mine) == 1:
            k, ends, leaves = len(some), seqs[mine[0]], 1
        else:
            left = []
            for i in mine:
                if len(ids[i]) == k:
                    ends = seqs[i]
                else:
                    left.append(i)
            stack = [left]
            while stack:
                part = stack.pop()
                if not part:
                    continue
                pivot = ids[part[len(part) // 2]][k]
                less, same, more = [], [], []
                for i in part:
                    x = ids[i][k]
                    (same if x == pivot else less if x < pivot else more).append(i)
                children += 1
                below = node(same, k + 1, conv)
                leaves, saved = leaves + below[0], saved + below[1]
                stack += (less, more)
        for at in range(k, first - 1, -1):
            saved += (n - 1) * sizes[mine[0]][at - 1]
            nodes.append((conv, top + at - 1, conv if at > first else above, n, children if at == k else 1, leaves, saved, ends if at == k else None))
        return leaves, saved

    node(list(range(len(ids))), 1, parent)
    return nodes


def _buckets(batches):
    """Nodes of each bucket from its rows, sorted by bucket, sequence and place."""
    kinds = [pa.int64()] * 8
    held: list[pa.Table] = []

    def nodes(t: pa.Table):
        bucket, depth, seq = (t.column(c).to_numpy() for c in ("conv", "top", "seq"))
        fresh = np.append(True, (bucket[1:] != bucket[:-1]) | (depth[1:] != depth[:-1]))
        begins = np.flatnonzero(np.append(True, fresh[1:] | (seq[1:] != seq[:-1])))
        ends = np.append(begins[1:], len(seq))
        ids, sizes = t.column("id").to_pylist(), t.column("bytes").to_pylist()
        n, above = t.column("n").to_numpy(), t.column("parent_conv_id").to_numpy()
        found: list[tuple] = []
        groups = np.append(np.flatnonzero(fresh[begins]), len(begins)).tolist()
        for a, b in zip(groups[:-1], groups[1:], strict=True):
            spans = [(int(begins[i]), int(ends[i])) for i in range(a, b)]
            at = spans[0][0]
            found += multikey_nodes([ids[p:q] for p, q in spans], [sizes[p:q] for p, q in spans], [int(seq[p]) for p, _ in spans], [int(n[p]) for p, _ in spans], int(depth[at]), int(above[at]))
            if len(found) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=NODE_COLUMNS)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=NODE_COLUMNS)

    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        bucket, depth = whole.column("conv").to_numpy(), whole.column("top").to_numpy()
        begins = np.flatnonzero((bucket[1:] != bucket[:-1]) | (depth[1:] != depth[:-1])) + 1
        last = int(begins[-1]) if len(begins) else 0
        if last:
            yield from nodes(whole.slice(0, last))
        held = [whole.slice(last)]
    if held:
        yield from nodes(pa.concat_tables(held))


def _paths(rows: DataFrame) -> DataFrame:
    """Nodes of sequences that are alone in their bucket: one for each row from the bucket's depth on."""
    last = F.col("pos") == F.col("len")
    below = F.sum((F.col("n") - 1) * F.col("bytes")).over(Window.partitionBy("seq").orderBy(F.desc("pos")))
    copies, single = rows.where("n > 1").withColumn("saved", below), rows.where("n = 1").withColumn("saved", F.expr("0L"))
    return single.unionByName(copies).select(
        F.col("seq").alias("conv_id"), F.col("pos").alias("depth"), F.when(F.col("pos") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("seq")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.expr("0L")).otherwise(F.expr("1L")).alias("n_children"), F.expr("1L").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.when(last, F.col("seq")).alias("end_seq"))


def trie_nodes(seqs: DataFrame, rows: DataFrame, local: int = LOCAL) -> DataFrame:
    """Nodes (columns NODE) of the trie of distinct sequences (seq, len, n) with rows (seq, pos, id, bytes).

    end_seq: the sequence that ends at the node, if any. No sequences, no nodes; one of length 0 ends at the root."""
    whole = seqs.agg(F.min("seq"), F.sum("n")).first()
    if whole[0] is None:
        return seqs.sparkSession.createDataFrame([], NODE)
    spark, levels, done = seqs.sparkSession, [], []
    # buckets to split: (conv, top, parent_conv_id, n_convs, split), with the chain of nodes from top to split
    buckets = spark.createDataFrame([(whole[0], 0, None, whole[1], 0)], "conv long, top long, parent_conv_id long, n_convs long, split long")
    chain = spark.createDataFrame([(whole[0], 0, 0)], "conv long, depth long, bytes long")
    members = seqs.select("seq", "len", "n", F.lit(whole[0]).alias("conv"), F.expr("0L").alias("split"))
    while True:
        ended = members.where(F.col("len") == F.col("split")).select("conv", F.col("seq").alias("end_seq"))
        at = members.where(F.col("len") > F.col("split")).join(rows, "seq").where(F.col("pos") == F.col("split") + 1).select("seq", "len", "n", F.col("conv").alias("above"), "split", "id", "bytes")
        groups = at.groupBy("above", "split", "id").agg(F.min("seq").alias("conv"), F.sum("n").alias("n_convs"), F.count("*").alias("seqs"), F.sum(F.col("len") - F.col("split")).alias("turns"), F.max("bytes").alias("bytes"))
        kind = F.when(F.col("seqs") == 1, "path").when(F.col("turns") <= local, "local").otherwise("split")
        groups = cut(groups.withColumn("kind", kind), "groups")
        levels.append((buckets, chain, ended, groups))
        placed = at.join(groups.select("above", "split", "id", "conv", "kind"), ["above", "split", "id"])
        placed = cut(placed.select("seq", "len", "n", "conv", (F.col("split") + 1).alias("top"), F.col("above").alias("parent_conv_id"), "kind"), "placed")
        done.append(placed.where("kind <> 'split'"))
        if groups.where("kind = 'split'").isEmpty():
            break
        # where the sequences of a bucket part: the first place that some lack or where ids differ
        held = placed.where("kind = 'split'").select("seq", "len", "n", "conv", "top")
        sizes = groups.where("kind = 'split'").select("conv", "above", "n_convs", "seqs", (F.col("split") + 1).alias("top"))
        places = held.select("seq", "conv", "top").join(rows, "seq").where(F.col("pos") >= F.col("top")).groupBy("conv", "pos").agg(
            F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("held"), F.max("bytes").alias("bytes"))
        places = cut(places.join(sizes.select("conv", "seqs"), "conv").withColumn("same", (F.col("low") == F.col("high")) & (F.col("held") == F.col("seqs"))), "places")
        splits = places.groupBy("conv").agg(F.min(F.when(~F.col("same"), F.col("pos"))).alias("parts"), F.max("pos").alias("last"))
        splits = splits.select("conv", F.coalesce(F.col("parts") - 1, F.col("last")).alias("split"))
        buckets = cut(sizes.join(splits, "conv").select("conv", "top", F.col("above").alias("parent_conv_id"), "n_convs", "split"), "buckets")
        chain = places.join(buckets.select("conv", "split"), "conv").where(F.col("pos") <= F.col("split")).select("conv", F.col("pos").alias("depth"), "bytes")
        members = held.join(buckets.select("conv", "split"), "conv").select("seq", "len", "n", "conv", "split")
    finished = done[0]
    for more in done[1:]:
        finished = finished.unionByName(more)
    mine = finished.join(rows, "seq").where(F.col("pos") >= F.col("top")).select("conv", "top", "parent_conv_id", "kind", "seq", "len", "n", "pos", "id", "bytes")
    small = mine.where("kind = 'local'").drop("kind", "len").repartition("conv", "top").sortWithinPartitions("conv", "top", "seq", "pos")
    nodes = cut(small.mapInArrow(lean(_buckets), NODE).unionByName(_paths(mine.where("kind = 'path'"))), "nodes")
    tops = nodes.select("conv_id", "depth", "n_leaves", "saved_tokens")
    for buckets, chain, ended, groups in reversed(levels):
        kids = groups.select("above", F.col("conv").alias("conv_id"), (F.col("split") + 1).alias("depth")).join(tops, ["conv_id", "depth"])
        sums = kids.groupBy(F.col("above").alias("conv")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        own = buckets.join(sums, "conv", "left").join(ended, "conv", "left").join(chain, "conv")
        last = F.col("depth") == F.col("split")
        saved = F.coalesce("below", F.expr("0L")) + F.sum((F.col("n_convs") - 1) * F.col("bytes")).over(Window.partitionBy("conv").orderBy(F.desc("depth")))
        own = own.select(
            F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv")).alias("parent_conv_id"), "n_convs",
            F.when(last, F.coalesce("n_children", F.expr("0L"))).otherwise(F.expr("1L")).alias("n_children"), F.coalesce("n_leaves", F.expr("1L")).alias("n_leaves"),
            saved.alias("saved_tokens"), F.when(last, F.col("end_seq")).alias("end_seq"))
        own = cut(own, "nodes")
        nodes = nodes.unionByName(own)
        tops = tops.unionByName(own.select("conv_id", "depth", "n_leaves", "saved_tokens"))
    return nodes


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row for each prefix of the rebuilt conversations (conv_id, turn, role, text), the root included: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    See turn_rows and rebuilt for nulls, ties and order. Repeated rows are turns of their own; a conversation that is left
    without turns is a member of the root; without conversations there is no row. Other columns are ignored."""
    seqs, rows, ends = sequences(*rebuilt(cut(turn_rows(conversations), "placed")))
    nodes = trie_nodes(seqs, rows, local).join(ends.withColumnRenamed("seq", "end_seq"), "end_seq", "left")
    return nodes.select(*NODE_COLUMNS[:-1], F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


#: CRC-32 of a decimal text, bit by bit.
_CRC = """
    xor(list_reduce(list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint),
        lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: case when p & 1 = 1 then xor(p >> 1, 3988292384) else p >> 1 end), 4294967295::bigint), 4294967295::bigint)
"""
ORACLE_SQL = f"""
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
     o as (select c, role, text, row_number() over (partition by c order by turn nulls first, md5(strlen(role)::varchar || ':' || role || text)) as pos,
                  dense_rank() over (order by role, text) as id from t),
     c as (select c, c - c % 5 as b, ({_CRC}) % 9 as h from (select distinct c from t)),
     r as (select c.c, 0 as own, o.pos, o.id, strlen(o.text) as bytes from c join o on o.c = c.b and o.pos <= c.h
           union all select c.c, 1, o.pos, o.id, strlen(o.text) from c join o on o.c = c.c and o.pos > c.h),
     s as (select c.c, coalesce(l, []) as l, coalesce(y, []) as y from c left join
           (select c, list(id order by own, pos) as l, list(bytes order by own, pos) as y from r group by c) using (c)),
     p as (select c, unnest(range(0, len(l) + 1)) as d, l, y from s),
     n as (select d, l[1:d] as path, min(c) as c, count(*) as n, any_value(y[d]) as bytes,
                  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (len(l) = d), '')) as ends from p group by 1, 2),
     k as (select d - 1 as d, path[1:d - 1] as path, count(*) as children from n where d > 0 group by 1, 2),
     m as (select n.*, coalesce(children, 0) as children, (n - 1) * coalesce(bytes, 0) as own from n left join k on n.d = k.d and n.path = k.path),
     u as (select unnest(range(0, d + 1)) as a, path, children, own from m),
     v as (select a as d, path[1:a] as path, sum((children = 0)::int) as leaves, sum(own) as saved from u group by 1, 2)
select m.c as conv_id, m.d::bigint as depth, q.c as parent_conv_id, m.n as n_convs, m.children as n_children, v.leaves::bigint as n_leaves, v.saved::bigint as saved_tokens, m.ends as ends_sha256
from m join v on m.d = v.d and m.path = v.path left join n q on q.d = m.d - 1 and q.path = m.path[1:m.d - 1] and m.d > 0
"""
