"""The life cycle of tasks as a state machine over the stream of their events, in any order and any number of deliveries."""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS = "task_id string, status string, attempts int, outcome string, overdue boolean, position long"
COLUMNS = [c.split()[0] for c in STATUS.split(", ")]
#: The status that an event leaves a task in; others leave it as it is.
LEADS_TO = {
    "generation.task.created": "CREATED", "seed.rejected": "SEEDING", "seed.validated": "GENERATING", "data.generated": "VALIDATING", "data.generation.rejected": "REGENERATING",
    "data.verification.judged": "VERIFYING", "data.verification.rejected": "REGENERATING", "sample.formatted": "ACCEPTED", "sample.accepted": "ACCEPTED", "generation.task.rejected": "REJECTED", "generation.task.replaced": "REJECTED",
}


@dataclass
class Standing:
    status: str = "CREATED"
    attempts: int = 0
    outcome: str | None = None
    position: int = -1


def standing(events: list[tuple[int, str, str | None]]) -> Standing:
    """Where a task stands after its events (position, type, route or outcome), whatever order they came in; equal positions are one
    event. attempts: candidates generated; outcome: of the last one that was routed or judged."""
    now, route = Standing(), None
    for position, kind, word in sorted(set(events), key=lambda e: e[0]):
        now.status, now.position = LEADS_TO.get(kind, now.status), position
        if kind == "data.generated":
            now.attempts, now.outcome, route = now.attempts + 1, None, None
        elif kind == "data.deterministic.validated":
            route = word
        elif kind == "data.generation.rejected":
            now.outcome = "REJECTED" if route == "REJECTED" else "REGENERATE"
        elif kind == "data.verification.judged":
            now.outcome = word
        elif kind == "sample.accepted":
            now.outcome = now.outcome or "PASS"
    return now


def task_events(events: DataFrame) -> DataFrame:
    """(task_id, event_type, position, word) of the events that are about a task; word: its route or outcome."""
    kinds = F.col("event_type").isin(*LEADS_TO, "data.deterministic.validated")
    return events.where(kinds & F.col("causation_id").isNotNull()).select(
        F.col("causation_id").alias("task_id"), "event_type", "position", F.coalesce(F.get_json_object("payload", "$.route"), F.get_json_object("payload", "$.outcome")).alias("word"))


def task_states(events: DataFrame) -> DataFrame:
    """(STATUS) of each task of a table of events: one row a task. A task's events are few: some for each attempt. No Python runs."""
    rows = task_events(events).dropDuplicates(["task_id", "position"])
    told = rows.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("position", F.col("event_type").alias("kind"), "word"))).alias("told"))
    among = lambda *kinds: lambda e: e["kind"].isin(*kinds)
    leads = F.create_map(*(F.lit(x) for pair in LEADS_TO.items() for x in pair))
    last = lambda xs: F.get(xs, F.size(xs) - 1)
    told = told.withColumn("made", F.filter("told", among("data.generated")))
    since = F.coalesce(last(F.col("made"))["position"], F.lit(-1))
    told = told.withColumn("tail", F.filter("told", lambda e: e["position"] > since))
    route = last(F.filter("tail", among("data.deterministic.validated")))["word"]
    outcomes = F.transform(F.filter("tail", among("data.generation.rejected", "data.verification.judged")), lambda e: F.when(e["kind"] == "data.verification.judged", e["word"]).when(route == "REJECTED", "REJECTED").otherwise("REGENERATE"))
    accepted = F.when(F.exists("tail", among("sample.accepted")), "PASS")
    status = F.coalesce(leads[last(F.filter("told", among(*LEADS_TO)))["kind"]], F.lit("CREATED"))
    return told.select("task_id", status.alias("status"), F.size("made").alias("attempts"), F.coalesce(last(outcomes), accepted).alias("outcome"), F.lit(False).alias("overdue"), last(F.col("told"))["position"].alias("position"))


def task_state_stream(events: DataFrame, patience: float = 3600.0) -> DataFrame:
    """task_states of a streaming DataFrame: a row for each task that a micro-batch changes, and one with overdue true for a task
    that still waits for its judge `patience` seconds after it began to (by processing time).

    Events may come late, in any order and again. A task's state is its events' positions, types and words, some for each
    attempt. Needs the RocksDB state store, and a trigger by time: as timers may be due at any
    moment, availableNow would go on without end."""
    from pyspark.sql.streaming import StatefulProcessor

    class Machine(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle, self.kept = handle, handle.getValueState("events", "kept string")

        def _known(self) -> list:
            return [tuple(e) for e in json.loads(self.kept.get()[0])] if self.kept.exists() else []

        def handleInputRows(self, key, rows, timerValues):
            known = self._known()
            before = standing(known)
            for pdf in rows:
                words = pdf["word"].where(pdf["word"].notna(), None)
                known += [(int(p), k, w) for p, k, w in zip(pdf["position"], pdf["event_type"], words, strict=True)]
            known = sorted(set(known), key=lambda e: e[0])
            now = standing(known)
            self.kept.update((json.dumps(known),))
            if now.status == "VERIFYING" and before.status != "VERIFYING":
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(patience * 1000))
            if now != before:
                yield pd.DataFrame([(key[0], now.status, now.attempts, now.outcome, False, now.position)], columns=COLUMNS)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = standing(self._known())
            if now.status == "VERIFYING":
                yield pd.DataFrame([(key[0], now.status, now.attempts, now.outcome, True, now.position)], columns=COLUMNS)

        def close(self) -> None:
            pass

    return task_events(events).groupBy("task_id").transformWithStateInPandas(statefulProcessor=Machine(), outputStructType=STATUS, outputMode="Update", timeMode="ProcessingTime")
