"""Novelty of candidates against the last accepted samples of their run: in batches, and as keyed state of a stream."""

from __future__ import annotations

import json
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolith.functions import blocks
from annolith.functions.similar import TOGETHER, Recent, Search, together
from annolith.operators import audit
from annolith.operators.audit import GUARD_LIMIT, GUARD_WINDOW
from annolith.plans.catalog import CATEGORICAL

MODES = ("off", "audit", "enforce")
FEEDBACK = 3
ISSUES = "array<struct<type:string,scope:string,label:string,value:string>>"
#: Accepted rows of a run that one task goes through, where what is accepted is known beforehand.
BLOCK = 500
#: Rows at the beginning of a run that are compared with each other in one go with those of other runs.
EARLY = 8


class Memory:
    """The last accepted samples of a run, and what a candidate is told about them."""

    def __init__(self, mode: str, limit: float, window: int, feedback: int, known: dict[tuple[str, str], float] | None = None):
        self.mode, self.limit, self.feedback, self.recent = mode, min(limit, 1.0), feedback, Recent(window, known=known)

    @staticmethod
    def values(entities) -> list[tuple[str, str, str]]:
        return [(e["label"], (e["value"] or "").strip().casefold(), e["value"]) for e in (entities if entities is not None else ()) if e["label"] not in CATEGORICAL]

    def keep(self, skeleton: str | None, entities) -> None:
        self.recent.add(skeleton or "", {(a, b) for a, b, _ in self.values(entities)})

    def ask(self, skeleton: str | None, entities) -> tuple[Search, list[dict]]:
        """(search for the most similar of what is kept now, issues of values)."""
        if self.mode == "off":
            return Recent(1).search("", 0), []
        used = set().union(*self.recent.values) if self.recent.values else set()
        issues = [{"type": "duplicate_entity_value", "scope": "SEEDS", "label": a, "value": v} for a, b, v in self.values(entities) if (a, b) in used]
        return self.recent.search(skeleton or "", max(1, self.feedback)), issues

    def answer(self, near: list[tuple[float, str]], issues: list[dict], valid) -> tuple[float, list[str], list[dict], bool]:
        """(max_similarity, nearest, novelty_issues, accepted) by what a search has found."""
        if near and near[0][0] >= self.limit:
            issues = [*issues, {"type": "duplicate_sentence_skeleton" if near[0][0] == 1.0 else "near_duplicate_sentence", "scope": "TEXT", "label": None, "value": None}]
        return near[0][0] if near else 0.0, [s for _, s in near[: self.feedback]], issues, bool(valid) and not (self.mode == "enforce" and issues)

    def judge(self, skeleton: str | None, entities, valid) -> tuple[float, list[str], list[dict], bool]:
        """The answer for a candidate; an accepted one is kept."""
        search, issues = self.ask(skeleton, entities)
        told = self.answer(together([search])[0], issues, valid)
        if told[3]:
            self.keep(skeleton, entities)
        return told

    def dump(self) -> str:
        return json.dumps([(text, sorted(values)) for text, values in self.recent.in_order()], ensure_ascii=False)

    def load(self, text: str) -> None:
        for skeleton, values in json.loads(text):
            self.recent.add(skeleton, {tuple(v) for v in values})


def _schema(rows: DataFrame, run: str, order: str) -> str:
    key = dict(rows.dtypes)
    return f"`{run}` {key[run]}, `{order}` {key[order]}, max_similarity double, nearest array<string>, novelty_issues {ISSUES}, accepted boolean"


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")


def first_ratios(records: list[dict]) -> dict[tuple[str, str], float]:
    """Ratios of the first EARLY rows of each run with those before them, of all runs at once: short runs need nearly all of them."""
    pairs, key, before = {}, None, []
    for r in records:
        if (now := (r["_run"], r["_block"])) != key or not before:
            key, before = now, []
        text = r["skeleton"] or ""
        if len(before) < EARLY:
            if r["_told"]:
                pairs.update(dict.fromkeys((text, x) for x in before))
            before.append(text)
    firsts, seconds = [a for a, _ in pairs], [b for _, b in pairs]
    return dict(zip(pairs, blocks.ratios(firsts, seconds).tolist(), strict=True))


def guard(rows: DataFrame, mode: str = "audit", run: str = "run_id", order: str = "sequence_no", limit: float = GUARD_LIMIT, window: int = GUARD_WINDOW, feedback: int = FEEDBACK) -> DataFrame:
    """(run, order, max_similarity, nearest, novelty_issues, accepted) of rows (run, order, skeleton, entities, valid).

    A row with a true column `prior`, if there is one, was accepted in an earlier round: it comes first and isn't judged.

    Each candidate is held against the `window` results of its run accepted before it, in order; nearest lists the most
    similar skeletons, `feedback` at most, for a new attempt. A value of a label that is not categorical and was accepted
    before, an equal skeleton and one of ratio `limit` or more are issues. audit accepts every valid row; enforce only those
    without issues; off computes nothing and accepts valid rows. Rows of equal order come in order of their skeletons.

    Under enforce a row's fate depends on those before it, so a run's rows pass through one task, in order, with no more than
    `window` of them kept. Otherwise what is accepted is known: a run is cut into blocks with the accepted rows before them."""
    _check(mode)
    prior = F.coalesce(F.col("prior"), F.lit(False)) if "prior" in rows.columns else F.lit(False)
    own = rows.select(F.col(run).alias("_run"), F.col(order).alias("_order"), "skeleton", "entities", F.coalesce("valid", F.lit(False)).alias("valid"), prior.alias("prior"))
    line = [F.desc("prior"), F.asc("_order"), F.asc("skeleton")]
    if mode == "enforce":
        dealt = own.withColumns({"_block": F.expr("0L"), "_told": ~F.col("prior")})
    else:
        size = max(BLOCK, window)
        counted = F.when(F.col("valid") | F.col("prior"), 1).otherwise(0)
        dealt = audit.numbered(own, line, counted).withColumn("_mine", F.floor(F.col("_at") / size))
        next_ = F.when((counted == 1) & (F.col("_at") % size >= size - window), F.col("_mine") + 1)
        dealt = dealt.withColumn("_block", F.explode(F.filter(F.array("_mine", next_), lambda b: b.isNotNull())))
        dealt = dealt.withColumn("_told", (F.col("_block") == F.col("_mine")) & ~F.col("prior")).drop("_at", "_mine")
    # a number of its own, as few bytes make much work here and small parts would be put together
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    # a run's blocks go to tasks in turn, so that none gets several while others wait
    turn = F.pmod(F.xxhash64("_run") % tasks + F.col("_block"), F.lit(tasks)).cast("int")
    dealt = dealt.repartitionById(tasks, turn).sortWithinPartitions("_run", "_block", *line)

    def judged(frames):
        key = memory = None
        known: dict[tuple[str, str], float] = {}
        for pdf in frames:
            out, records = [], pdf.to_dict("records")
            known.clear()
            known.update(first_ratios(records) if mode == "enforce" else {})
            for a in range(0, len(records), TOGETHER):
                asked = []
                for r in records[a : a + TOGETHER]:
                    if (r["_run"], r["_block"]) != key or memory is None:
                        key, memory = (r["_run"], r["_block"]), Memory(mode, limit, window, feedback, known)
                    if r["_told"] and mode == "enforce":
                        out.append((r["_run"], r["_order"], *memory.judge(r["skeleton"], r["entities"], r["valid"])))
                        continue
                    if r["_told"]:  # what is kept doesn't hang on what is found, so rows can wait for each other
                        asked.append((r, *memory.ask(r["skeleton"], r["entities"])))
                    if r["prior"] or r["valid"]:
                        memory.keep(r["skeleton"], r["entities"])
                found = together([search for _, search, _ in asked])
                out += [(r["_run"], r["_order"], *memory.answer(near, issues, r["valid"])) for (r, _, issues), near in zip(asked, found, strict=True)]
            yield pd.DataFrame(out, columns=[run, order, "max_similarity", "nearest", "novelty_issues", "accepted"])

    return dealt.select("_run", "_block", "_order", "skeleton", "entities", "valid", "prior", "_told").mapInPandas(judged, _schema(rows, run, order))


def last_accepted(accepted: DataFrame, window: int, run: str = "run_id", order: str = "sequence_no") -> DataFrame:
    """The rows of accepted that a later round can meet: the last `window` of each run."""
    newest = Window.partitionBy(run).orderBy(F.desc(order))
    return accepted.withColumn("_newest", F.row_number().over(newest)).where(F.col("_newest") <= window).drop("_newest")


def guard_stream(rows: DataFrame, mode: str = "enforce", run: str = "run_id", order: str = "sequence_no", limit: float = GUARD_LIMIT, window: int = GUARD_WINDOW, feedback: int = FEEDBACK) -> DataFrame:
    """guard of a streaming DataFrame: each run's last `window` accepted skeletons and values are its state.

    Rows count in the order of their micro-batches and, within one, of `order`; if they come in order, the result is that of
    guard. State of a run is one value of bounded size. Needs the RocksDB state store."""
    from pyspark.sql.streaming import StatefulProcessor

    _check(mode)
    columns = [run, order, "max_similarity", "nearest", "novelty_issues", "accepted"]
    fresh = partial(Memory, mode, limit, window, feedback)

    class Novelty(StatefulProcessor):
        def init(self, handle) -> None:
            self.state = handle.getValueState("recent", "kept string")

        def handleInputRows(self, key, rows, timerValues):
            memory = fresh()
            if self.state.exists():
                memory.load(self.state.get()[0])
            pdf = pd.concat(list(rows)).sort_values([order, "skeleton"], kind="stable")
            out = [(r[run], r[order], *memory.judge(r["skeleton"], r["entities"], r["valid"])) for r in pdf.to_dict("records")]
            self.state.update((memory.dump(),))
            yield pd.DataFrame(out, columns=columns)

        def close(self) -> None:
            pass

    own = rows.select(run, order, "skeleton", "entities", F.coalesce("valid", F.lit(False)).alias("valid"))
    return own.groupBy(run).transformWithStateInPandas(statefulProcessor=Novelty(), outputStructType=_schema(rows, run, order), outputMode="Append", timeMode="None")


def issue_types(issues: Column) -> Column:
    return F.transform(issues, lambda i: i["type"])
