"""Diversity audit and novelty guards over accepted samples."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolith import shared
from annolith.functions import text as T
from annolith.functions.similar import TOGETHER, Recent, together
from annolith.functions.tags import skeleton
from annolith.plans.catalog import CATEGORICAL

AUDIT_LIMIT, AUDIT_WINDOW, GUARD_LIMIT, GUARD_WINDOW = 0.88, 200, 0.9, 100
#: Rows of a run that are compared in one task.
BLOCK = 1000


def unique_ratios(entities: DataFrame) -> DataFrame:
    """(label, values, distinct_values) of (label, value); ratio = distinct_values / values."""
    return entities.groupBy("label").agg(F.count("*").alias("n_values"), F.count_distinct(T.fold_key(F.col("value"))).alias("n_distinct"))


def duplicate_counts(skeletons: DataFrame) -> DataFrame:
    """(n, duplicates) of (skeleton): rows beyond the first of each skeleton."""
    each = skeletons.groupBy("skeleton").agg(F.count("*").alias("n"))
    return each.agg(F.sum("n").cast("long").alias("n"), F.sum(F.col("n") - 1).cast("long").alias("duplicates"))


def numbered(rows: DataFrame, line: list[Column], counted: Column) -> DataFrame:
    """rows (_run, ...) with _at, how many of the rows before them in their run's line are counted (1, else 0). Rows are dealt by ranges, so
    that a run of any size goes over many tasks, and are numbered within a range, after the counts of their run's ranges before."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    # written, as ranges are drawn from a sample and a second reading could draw others
    dealt = shared.cut(rows.repartitionByRange(tasks, "_run", *line).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(F.col("_run").alias("_of"), F.col("_part").alias("_in")).agg(F.sum(counted).alias("_n"))
    sizes = sizes.select("_of", "_in", (F.sum("_n").over(Window.partitionBy("_of").orderBy("_in")) - F.col("_n")).alias("_before"))
    own = Window.partitionBy("_run", "_part").orderBy(*line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("_place", F.sum(counted).over(own) - counted)
    placed = placed.join(sizes, F.col("_run").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
    return placed.withColumn("_at", F.col("_before") + F.col("_place")).drop("_of", "_in", "_before", "_place", "_part")


def _numbered(rows: DataFrame) -> DataFrame:
    """rows (_run, _order, _text, ...) with _at, their number within their run by order and text."""
    return numbered(rows, [F.asc("_order"), F.asc("_text")], F.lit(1)).drop("_order")


def near_duplicates(rows: DataFrame, run: str, order: str, text_col: str, limit: float = AUDIT_LIMIT, window: int = AUDIT_WINDOW) -> DataFrame:
    """rows with best_ratio and near_duplicate: difflib's ratio to the most similar, but different, of the `window` texts before in
    the run, 0 where none has `limit` or more.

    A run is cut into blocks of consecutive rows, each with the `window` rows before it as well, so that blocks are compared in
    parallel and no row carries others' texts. Rows of one run and order are taken in order of their text."""
    size = max(BLOCK, window)
    clash = [c for c in rows.columns if c in ("best_ratio", "near_duplicate")]
    numbered = rows.drop(*clash).withColumn("_row", F.struct(*(c for c in rows.columns if c not in clash)))
    numbered = _numbered(numbered.select("_row", F.col(run).alias("_run"), F.col(order).alias("_order"), F.col(text_col).alias("_text")))
    block = F.floor(F.col("_at") / size)
    dealt = numbered.withColumn("_block", F.explode(F.filter(F.array(block, F.when(F.col("_at") % size >= size - window, block + 1)), lambda b: b.isNotNull())))
    dealt = dealt.withColumn("_own", F.col("_at") >= F.col("_block") * size)
    # rows of the block before come for their texts alone
    dealt = dealt.select("_run", "_block", "_at", "_text", "_own", F.when(F.col("_own"), F.col("_row")).alias("_row"))
    dealt = dealt.repartition("_run", "_block").sortWithinPartitions("_run", "_block", "_at")

    def ratios(batches):
        key = recent = None
        for batch in batches:
            runs, blocks, texts, own = (batch.column(c).to_pylist() for c in ("_run", "_block", "_text", "_own"))
            found, searches = [], []
            for now, text, mine in zip(zip(runs, blocks, strict=True), texts, own, strict=True):
                if recent is None or now != key:
                    key, recent = now, Recent(window, kept_first=True)
                if mine:
                    searches.append(recent.search(text or "", 1, limit, differ=True))
                recent.add(text or "")
                if len(searches) == TOGETHER:
                    found, searches = found + together(searches), []
            found = [next((r for r, _ in near), 0.0) for near in found + together(searches)]
            rows_ = batch.column("_row").filter(pa.array(own, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rows_, pa.array(found, pa.float64())], names=["_row", "best_ratio"])

    kinds = numbered.schema["_row"].dataType.simpleString()
    found = dealt.mapInArrow(ratios, f"_row {kinds}, best_ratio double").select("_row.*", "best_ratio")
    return found.withColumn("near_duplicate", F.col("best_ratio") >= limit)


def reused_values(entities: DataFrame, run: str, order: str, window: int = GUARD_WINDOW) -> DataFrame:
    """entities (run, order, label, value) with reused: whether one of the run's last `window` numbers before had the value.

    A range self-comparison by the previous use of the same value: no join. Categorical labels are exempt."""
    same = Window.partitionBy(run, "label", T.fold_key(F.col("value"))).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    last = F.max(order).over(same)
    return entities.withColumn("reused", F.coalesce(F.col(order) - last <= window, F.lit(False)) & ~F.col("label").isin(*CATEGORICAL))


def closest_example(text: Column, examples: Column) -> Column:
    """struct<closest, sequence, ngram> of the example most like a text by either measure, the first of equal ones; null without examples."""
    return T.closest_example(text, examples)


def imitates(closest: Column) -> Column:
    return F.coalesce((closest["sequence"] >= T.SEQUENCE_LIMIT) | (closest["ngram"] >= T.NGRAM_LIMIT), F.lit(False))


def imitation(rows: DataFrame, text_col: str, examples_col: str) -> DataFrame:
    """rows (key..., text, examples array<string>) with closest, sequence, ngram, imitates: against each row's few examples.

    One row out for each row in; without examples the measures are null and nothing is imitated."""
    keys = [c for c in rows.columns if c not in (text_col, examples_col)]
    # dealt by the keys before the comparisons, so that few large files still use all cores
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = rows.repartition(n, *keys).select(*keys, closest_example(F.col(text_col), F.col(examples_col)).alias("best"))
    return out.select(*keys, "best.closest", "best.sequence", "best.ngram", imitates(F.col("best")).alias("imitates"))


def with_seed_events(results: DataFrame, events: DataFrame) -> DataFrame:
    """results (task_id, ...) with decoys, strategy_ids and frame_id of the task's last seed.validated event, null without one.

    events: (event_type, causation_id, idempotency_key, payload), a seed event's payload holding attempt, frame, decoys."""
    schema = "attempt int, frame string, decoys array<struct<strategy_id:string,value:string>>"
    seeds = events.where("event_type = 'seed.validated'").select(F.col("causation_id").alias("task_id"), F.from_json("payload", schema).alias("p"))
    last = seeds.groupBy("task_id").agg(F.max_by("p", F.col("p.attempt")).alias("p"))
    part = lambda f: F.transform("p.decoys", lambda d: d[f])
    return results.join(last.select("task_id", part("value").alias("decoys"), part("strategy_id").alias("strategy_ids"), F.col("p.frame").alias("frame_id")), "task_id", "left")


def frequencies(rows: DataFrame, *by: str) -> DataFrame:
    """(by..., n): how often each combination occurs."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def dialogue_shape(rows: DataFrame, run: str, order: str, speaker: str) -> DataFrame:
    """(run, first_turn, turns, alternates, two_speakers) of conversations."""
    before = F.lag(speaker).over(Window.partitionBy(run).orderBy(order))
    rows = rows.withColumn("_ok", F.coalesce(F.col(speaker) != before, F.lit(True)))
    return rows.groupBy(run).agg(F.min(order).alias("first_turn"), F.count("*").alias("turns"), F.every("_ok").alias("alternates"), (F.count_distinct(speaker) == 2).alias("two_speakers"))


#: n-grams of the smaller side that are broadcast; more are joined by a shuffle.
BROADCAST_GRAMS = 2_000_000


def shared_ngrams(docs: DataFrame, items: DataFrame, doc: str, item: str) -> DataFrame:
    """(doc, item, common, total) of every pair of docs and items (key, tokens array) that share an n-gram of the pair's width.

    The width is 2 where either side has under 8 tokens, else 3. Each side lists only the widths that a pair could need; items
    are the small side, broadcast once their n-grams are counted."""
    both = lambda df, key, short_other: df.select(key, F.size("tokens").alias("size"), "tokens", F.explode(F.when(F.size("tokens") < 8, F.array(F.lit(2))).otherwise(F.array(F.lit(2), F.lit(3)) if short_other else F.array(F.lit(3)))).alias("w"))
    grams = lambda df, key, short_other, pre: both(df, key, short_other).withColumn("g", T.ngrams(F.col("tokens"), F.col("w"))).select(key, F.col("size").alias(f"{pre}_size"), "w", F.size("g").alias(f"{pre}_n"), F.explode("g").alias("gram"))
    short_items = not items.where(F.size("tokens") < 8).isEmpty()
    right = grams(items, item, True, "i")
    right = F.broadcast(right) if right.count() <= BROADCAST_GRAMS else right
    met = grams(docs, doc, short_items, "d").join(right, ["w", "gram"]).where((F.col("w") == 2) == (F.least("d_size", "i_size") < 8))
    return met.groupBy(doc, item, "d_n", "i_n").agg(F.count("*").alias("common")).select(doc, item, "common", (F.col("d_n") + F.col("i_n") - F.col("common")).cast("long").alias("total"))


def report(samples: DataFrame) -> DataFrame:
    """One row: duplicate rates, unique ratios, coverage and frequencies of samples (run_id, sequence_no, tagged_text, entities, decoys array<string>, frame_id, strategy_ids, constraints, variants array<struct<label, variant>>)."""
    rows = samples.withColumn("skeleton", skeleton(F.col("tagged_text"), F.col("decoys")))
    entities = samples.select(F.explode("entities").alias("e")).select("e.*")
    ratio = unique_ratios(entities)
    as_map = lambda df, k, v, name: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias(name))
    counts = lambda col, name: as_map(samples.select(F.explode(col).alias("k")).where("k <> ''").groupBy("k").agg(F.count("*").alias("n")), "k", "n", name)
    out = duplicate_counts(rows)
    out = out.join(near_duplicates(rows.select("run_id", "sequence_no", "skeleton"), "run_id", "sequence_no", "skeleton").agg(F.avg(F.col("near_duplicate").cast("double")).alias("near_duplicate_rate")))
    out = out.join(as_map(ratio.where(~F.col("label").isin(*CATEGORICAL)), "label", (F.col("n_distinct") / F.col("n_values")).alias("r"), "unique_ratio"))
    out = out.join(as_map(ratio.where(F.col("label").isin(*CATEGORICAL)), "label", "n_distinct", "coverage"))
    variants = F.transform("variants", lambda v: F.concat(v["label"], F.lit(":"), v["variant"]))
    for col, name in ((F.array("frame_id"), "frames"), (F.col("strategy_ids"), "strategies"), (F.col("constraints"), "constraint_counts"), (variants, "variant_counts")):
        out = out.join(counts(col, name))
    return out.withColumn("exact_duplicate_rate", F.col("duplicates") / F.col("n"))
