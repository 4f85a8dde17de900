"""Interval overlap join of two tables by key, with the relation of each pair, summed up where the pairs are found.

1. Ends are slots (floored times); an open end is the sentinel OPEN, later than any slot and equal to itself. Intervals of
   equal key and slots are one class with a count and a sum, so work follows the classes and not the rows behind them.
2. Classes are dealt by key. A key of more than SHARD classes, such as one client with a third of all rows, is cut along
   time as well: an interval lies in every shard from its start to its end, and a pair counts in the shard of the later
   start, where one of the two is fresh. What is copied is classes, whose number follows the slots of the time range.
3. An Arrow task lays its keys side by side on one axis and lets DuckDB's range join (IEJoin) find overlaps by the two
   inequalities alone: fresh left with all right classes, then older left with fresh right ones. Relation and sums are
   taken in the same DuckDB query, so a task gives a row for each left class and relation, never a pair.
4. Spark adds the partial sums of the shards and hands them to the rows of each left class.

Nothing is broadcast or collected. The tasks keep no state, so a lost executor costs their repetition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType
from pyspark.sql.window import Window

from annolith.llm.common import cut, lean

#: The end of an open interval.
OPEN = 1 << 62
#: Classes of a key up to which it stays in one shard, and rows that a task joins at once.
SHARD, AT_ONCE = 8192, 1 << 17
#: Seconds of a slot, and of the longest pause within a session.
SLOT, PAUSE = 6 * 3600, 30 * 60

#: Relation by (left start against right start, left end against right end); a shared slot is given.
JOIN = """
select a.id as id,
       case when a.lo < b.lo then case when a.hi < b.hi then 'overlaps' when a.hi = b.hi then 'finished_by' else 'contains' end
            when a.lo = b.lo then case when a.hi < b.hi then 'starts' when a.hi = b.hi then 'equals' else 'started_by' end
            else case when a.hi < b.hi then 'during' when a.hi = b.hi then 'finishes' else 'overlapped_by' end end as relation,
       b.n as n, b.total as total,
       case when a.hi >= {end} and b.hi >= {end} then null else least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1 end as shared
from {a} a join {b} b on a.lo <= b.hi and b.lo <= a.hi
"""
SUMS = """
select id, relation, sum(n)::bigint as n_pairs, sum(n * shared)::bigint as shared, sum(total)::bigint as total
from ({fresh} union all {older}) group by id, relation
"""


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time without a zone, taken as UTC, whatever the session's zone is."""
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.unix_micros(c)
    day = F.unix_date(c.cast("date")).cast("long")
    second = F.date_part(F.lit("SECOND"), c).cast("decimal(18,6)") * 1_000_000
    return (day * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60) * 1_000_000 + second.cast("long")


def _slot(c: Column, seconds: int) -> Column:
    step = F.lit(seconds * 1_000_000).cast("long")
    return F.call_function("div", c - F.pmod(c, step), step)


def sessions(clicks: DataFrame, key: str = "client_id", ts: str = "ts", kind: str = "kind", pause: int = PAUSE) -> DataFrame:
    """(key, first, last, open) of each session, in microseconds: a click more than `pause` seconds after the key's last one
    begins another. open: a click at the session's last time has kind error.

    Rows without key or time are ignored; repeated rows change nothing. Clicks of one stretch of `pause` seconds, counted
    from 1970, always share a session, so they fold into one row before any row moves; what is ordered by key is stretches,
    whose number follows the time range and not the clicks."""
    us = micros(clicks, ts)
    rows = clicks.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).cast("long").alias("key"), us.alias("us"), F.coalesce(F.col(kind) == "error", F.lit(False)).cast("long").alias("error"))
    parts = rows.groupBy("key", _slot(F.col("us"), pause).alias("stretch")).agg(F.min("us").alias("first"), F.max(F.col("us") * 2 + F.col("error")).alias("last"))
    order = Window.partitionBy("key").orderBy("stretch")
    before = _slot_half(F.lag("last").over(order))
    begins = F.when(before.isNull() | (F.col("first") - before > pause * 1_000_000), 1).otherwise(0)
    numbered = parts.withColumn("begins", begins).withColumn("no", F.sum("begins").over(order))
    found = numbered.groupBy("key", "no").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return found.select("key", "first", _slot_half(F.col("last")).alias("last"), (F.pmod("last", F.lit(2)) == 1).alias("open"))


def _slot_half(c: Column) -> Column:
    """Time of a value that holds time * 2 + flag."""
    return F.call_function("shiftright", c, F.lit(1))


def sale_spans(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, key, first, last, open) of each sale, in microseconds: from sold_at to the latest of it and its lines' shipped_at;
    open: status open. Sales without client or sold_at are ignored; repeated equal rows count once, rows of one sale that
    differ are intervals of their own. Lines without sale or time change nothing."""
    shipped = lines.where(F.col("sale_id").isNotNull() & F.col("shipped_at").isNotNull()).select(F.col("sale_id").alias("id"), micros(lines, "shipped_at").alias("us"))
    ends = shipped.groupBy("id").agg(F.max("us").alias("shipped"))
    rows = sales.where(F.col("client_id").isNotNull() & F.col("sold_at").isNotNull()).select(
        F.col("sale_id").alias("id"), F.col("client_id").cast("long").alias("key"), micros(sales, "sold_at").alias("first"), F.coalesce(F.col("status") == "open", F.lit(False)).alias("open"))
    return rows.join(ends, "id", "left").select("id", "key", "first", F.greatest("first", "shipped").alias("last"), "open").distinct()


def in_slots(spans: DataFrame, seconds: int = SLOT) -> DataFrame:
    """spans with lo and hi in slots, both inclusive; hi of an open one is OPEN."""
    hi = F.when(F.col("open"), F.lit(OPEN)).otherwise(_slot(F.col("last"), seconds))
    return spans.withColumns({"lo": _slot(F.col("first"), seconds), "hi": hi})


def _joined():
    import duckdb

    out = pa.schema([("key", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("relation", pa.string()), ("n_pairs", pa.int64()), ("shared", pa.int64()), ("total", pa.int64())])

    def sums(rows: pa.Table) -> list[pa.RecordBatch]:
        key, shard, lo, hi = (rows.column(c).to_numpy() for c in ("key", "shard", "lo", "hi"))
        fresh, right = rows.column("fresh").to_numpy().astype(bool), rows.column("right").to_numpy().astype(bool)
        if not right.any() or right.all():
            return []
        edge = np.append(True, (key[1:] != key[:-1]) | (shard[1:] != shard[:-1]))
        ended = hi < OPEN
        base = int(lo.min())
        span = max(int(lo.max()), int(hi[ended].max(initial=base))) - base + 2  # the last place is the open end's
        at = (np.cumsum(edge) - 1) * span
        a, b = at + lo - base, at + np.where(ended, hi - base, span - 1)
        con = duckdb.connect(":memory:", config={"threads": "1"})
        try:
            con.execute("set merge_join_threshold = 0; set nested_loop_join_threshold = 0; set preserve_insertion_order = false")
            for name, mine in (("left_new", ~right & fresh), ("left_old", ~right & ~fresh), ("right_all", right), ("right_new", right & fresh)):
                i = np.flatnonzero(mine)
                t = pa.table({"id": i, "lo": a[i], "hi": b[i], "n": rows.column("n").take(pa.array(i)), "total": rows.column("total").take(pa.array(i))})
                con.register(f"{name}_arrow", t)
                con.execute(f"create temp table {name} as select * from {name}_arrow")
                con.unregister(f"{name}_arrow")
            end = f"(a.lo - a.lo % {span}) + {span - 1}"
            got = con.sql(SUMS.format(fresh=JOIN.format(a="left_new", b="right_all", end=end), older=JOIN.format(a="left_old", b="right_new", end=end))).to_arrow_table()
        finally:
            con.close()
        i = got.column("id").to_numpy()
        found = pa.table({"key": key[i], "lo": lo[i], "hi": hi[i], "relation": got.column("relation"), "n_pairs": got.column("n_pairs"), "shared": got.column("shared"), "total": got.column("total")})
        return found.cast(out).combine_chunks().to_batches()

    def run(batches):
        held, n = [], 0
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if n + t.num_rows >= AT_ONCE and held:
                # cut where the last key and shard begin, unless they fill all that is held
                whole = pa.concat_tables([*held, t])
                key, shard = whole.column("key").to_numpy(), whole.column("shard").to_numpy()
                begins = np.flatnonzero((key[1:] != key[:-1]) | (shard[1:] != shard[:-1])) + 1
                if len(begins):
                    yield from sums(whole.slice(0, int(begins[-1])))
                    whole = whole.slice(int(begins[-1]))
                held, n = [whole], whole.num_rows
            elif t.num_rows:
                held.append(t)
                n += t.num_rows
        if held:
            yield from sums(pa.concat_tables(held))

    return run


def _sharded(classes: DataFrame, most: int) -> DataFrame:
    """classes with shard and fresh: keys of more than `most` classes are cut along time."""
    sizes = classes.groupBy("key").agg(F.count("*").alias("classes"), F.min("lo").alias("from"), F.max("lo").alias("to")).where(F.col("classes") > most)
    parts = F.call_function("ceil", F.col("classes") / F.lit(most)).cast("long")
    wide = sizes.select("key", "from", "to", F.greatest(F.lit(1), F.call_function("ceil", (F.col("to") - F.col("from") + 1) / parts)).cast("long").alias("width"))
    rows = classes.join(wide.hint("merge"), "key", "left")
    shard = lambda c: F.call_function("div", c - F.col("from"), F.col("width"))
    rows = rows.withColumns({"begins": F.coalesce(shard(F.col("lo")), F.expr("0L")), "ends": F.coalesce(shard(F.least("hi", "to")), F.expr("0L"))})
    rows = rows.select("key", "lo", "hi", "right", "n", "total", "begins", F.explode(F.sequence("begins", "ends")).alias("shard"))
    return rows.select("key", "lo", "hi", "right", "n", "total", "shard", (F.col("shard") == F.col("begins")).alias("fresh"))


def relation_sums(left: DataFrame, right: DataFrame, shard: int = SHARD) -> DataFrame:
    """(id, relation, n_pairs, shared, total): for each left row's id and relation, the right rows of its key that share a slot,
    the slots shared (null where both are open, as their share has no end) and the sum of the right rows' values.

    left: (id, key, lo, hi), right: (key, lo, hi, value), hi OPEN for an open end. Rows without key or lo, and rows that end
    before they start, share nothing. Equal rows are as many rows as they are; either side may be empty."""
    real = F.col("key").isNotNull() & (F.col("lo") <= F.col("hi"))
    left = left.where(real).select("id", "key", "lo", "hi")
    own = left.select("key", "lo", "hi").distinct().select("key", "lo", "hi", F.expr("1L").alias("n"), F.expr("0L").alias("total"), F.lit(False).alias("right"))
    other = right.where(real).groupBy("key", "lo", "hi").agg(F.count("*").alias("n"), F.coalesce(F.sum("value"), F.expr("0L")).alias("total"), F.lit(True).alias("right"))
    classes = cut(own.unionByName(other), "intervals")
    rows = _sharded(classes, shard).repartition("key", "shard").sortWithinPartitions("key", "shard")
    part = rows.select("key", "shard", "lo", "hi", "right", "fresh", "n", "total").mapInArrow(lean(_joined()), "key long, lo long, hi long, relation string, n_pairs long, shared long, total long")
    sums = part.groupBy("key", "lo", "hi", "relation").agg(*(F.sum(c).alias(c) for c in ("n_pairs", "shared", "total")))
    return left.join(sums, ["key", "lo", "hi"]).groupBy("id", "relation").agg(*(F.sum(c).alias(c) for c in ("n_pairs", "shared", "total")))


def sale_sessions(sales: DataFrame, lines: DataFrame, clicks: DataFrame) -> DataFrame:
    """(sale_id, relation, n_pairs, overlap_slots, sessions_crc): sales against the click sessions of the same client, in slots
    of six hours. sessions_crc sums the CRC-32 of each session's exact first time, as decimal microseconds since 1970.

    A sale without overlapping session has no row. See sessions, sale_spans and relation_sums for nulls and repeated rows;
    other columns are ignored."""
    found = in_slots(sessions(clicks)).select("key", "lo", "hi", F.crc32(F.col("first").cast("string").cast("binary")).alias("value"))
    sums = relation_sums(in_slots(sale_spans(sales, lines)), found)
    return sums.select(F.col("id").alias("sale_id"), "relation", "n_pairs", F.col("shared").alias("overlap_slots"), F.col("total").alias("sessions_crc"))


#: CRC-32 of a decimal text, bit by bit.
_CRC = """
    (xor(list_reduce(list_transform(string_split(x, ''), lambda c: ascii(c)::bigint),
         lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: case when p & 1 = 1 then xor(p >> 1, 3988292384) else p >> 1 end), 4294967295::bigint), 4294967295::bigint))
"""
ORACLE_SQL = f"""
with c as (select client_id, epoch_us(ts) as us, coalesce(kind = 'error', false) as error from clicks where client_id is not null and ts is not null),
     m as (select *, case when us - lag(us) over w <= 1800000000 then 0 else 1 end as begins from c window w as (partition by client_id order by us)),
     k as (select *, sum(begins) over (partition by client_id order by us rows unbounded preceding) as no from m),
     s as (select client_id, no, min(us) as first, max(us) as last, max(us * 2 + error::int) % 2 = 1 as open from k group by all),
     t as (select client_id, first // 21600000000 as lo, case when open then {OPEN} else last // 21600000000 end as hi, first::varchar as x from s),
     e as (select client_id, lo, hi, {_CRC} as crc from t),
     l as (select sale_id, max(shipped_at) as shipped from sale_lines group by sale_id),
     a as (select sale_id, client_id, epoch_us(sold_at) // 21600000000 as lo,
                  case when status = 'open' then {OPEN} else epoch_us(greatest(sold_at, shipped)) // 21600000000 end as hi
           from (select distinct sale_id, client_id, sold_at, coalesce(status, '') as status from sales) left join l using (sale_id)
           where client_id is not null and sold_at is not null),
     p as (select sale_id, case when a.lo < e.lo then case when a.hi < e.hi then 'overlaps' when a.hi = e.hi then 'finished_by' else 'contains' end
                                when a.lo = e.lo then case when a.hi < e.hi then 'starts' when a.hi = e.hi then 'equals' else 'started_by' end
                                when a.hi < e.hi then 'during' when a.hi = e.hi then 'finishes' else 'overlapped_by' end as relation,
                  case when a.hi = {OPEN} and e.hi = {OPEN} then null else least(a.hi, e.hi) - greatest(a.lo, e.lo) + 1 end as shared, crc
           from a join e on a.client_id = e.client_id and a.lo <= e.hi and e.lo <= a.hi)
select sale_id, relation, count(*) as n_pairs, sum(shared)::bigint as overlap_slots, sum(crc)::bigint as sessions_crc from p group by sale_id, relation
"""
