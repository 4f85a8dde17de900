import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from annolith.functions import detect, tags
from annolith.sources.clients import Pace, answers, call
from annolith.streaming.lifecycle import standing, task_state_stream, task_states

EVENTS = "causation_id string, event_type string, position long, payload string, correlation_id string, word string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)


def _event(task, n, kind, **payload):
    import json

    return (task, kind, n, json.dumps(payload), "r", "x")


def _story(task, ending):
    out = [_event(task, 1, "generation.task.created"), _event(task, 2, "seed.validated"), _event(task, 3, "data.generated"), _event(task, 4, "data.deterministic.validated", route="REGENERATE"), _event(task, 5, "data.generation.rejected", issues=[])]
    if ending == "failing":
        return out
    out += [_event(task, 6, "seed.validated"), _event(task, 7, "data.generated"), _event(task, 8, "data.deterministic.validated", route="PASS")]
    if ending == "plain":
        return [*out, _event(task, 9, "sample.formatted"), _event(task, 10, "sample.accepted")]
    word = {"waiting": "VERIFYING", "fixed": "FIXED", "refused": "REJECTED"}[ending]
    out.append(_event(task, 9, "data.verification.judged", outcome=word, stages=["judge"]))
    if ending == "fixed":
        return [*out, _event(task, 10, "sample.formatted"), _event(task, 11, "sample.accepted")]
    return [*out, _event(task, 10, "data.verification.rejected", outcome=word), _event(task, 11, "generation.task.rejected")] if ending == "refused" else out


WANT = {"failing": ("REGENERATING", 1, "REGENERATE"), "plain": ("ACCEPTED", 2, "PASS"), "waiting": ("VERIFYING", 2, "VERIFYING"), "fixed": ("ACCEPTED", 2, "FIXED"), "refused": ("REJECTED", 2, "REJECTED")}


def test_a_task_stands_where_its_events_say_in_any_order():
    for ending, want in WANT.items():
        events = [(n, kind, (lambda p: p.get("route") or p.get("outcome"))(__import__("json").loads(payload))) for _, kind, n, payload, *_ in _story("t", ending)]
        r = random.Random(1)
        for _ in range(5):
            shuffled = events + r.sample(events, 3)
            r.shuffle(shuffled)
            s = standing(shuffled)
            assert (s.status, s.attempts, s.outcome) == want


def test_life_cycle_as_a_stream(spark, tmp_path, rocks):
    """Events late, twice and out of order, over two starts on one checkpoint, lead to what the table of all of them says."""
    rows = list(itertools.chain(*(_story(f"{e}{i}", e) for e in WANT for i in range(4)))) + [_event(None, 1, "run.created"), _event("plain0", 12, "odd.type")]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, EVENTS)
    whole = {x.task_id: (x.status, x.attempts, x.outcome) for x in task_states(frame).collect()}
    assert whole == {f"{e}{i}": w for e, w in WANT.items() for i in range(4)}
    seen, overdue = {}, set()

    def keep(batch, n):
        for x in batch.collect():
            if x.overdue:
                overdue.add(x.task_id)
            elif x.task_id not in seen or x.position >= seen[x.task_id][0]:
                seen[x.task_id] = (x.position, (x.status, x.attempts, x.outcome))

    half = len(rows) // 2
    done = (lambda: len(seen) > 10, lambda: {t: s for t, (_, s) in seen.items()} == whole and {f"waiting{i}" for i in range(4)} <= overdue)
    for part, enough in zip((rows[:half], rows[half - 9 :]), done, strict=True):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = task_state_stream(spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")), patience=0.0)
        query = stream.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()
        until = time.time() + 100
        while not enough() and time.time() < until and query.isActive:
            time.sleep(0.2)
        query.stop()
        assert query.exception() is None and enough()


def test_calls_wait_side_by_side_and_keep_order(spark):
    live = []

    def connect():
        def send(body):
            live.append(body)
            most = len(live)
            time.sleep(0.2)
            live.remove(body)
            if body == "7":
                raise RuntimeError("broken")
            return 200, f"a{body} {most}"

        return send

    rows = spark.range(0, 40, 1, 1).select(F.col("id").cast("string").alias("id")).withColumn("body", F.when(F.col("id") != "9", F.col("id")))
    got = answers(rows, F.col("body"), connect, at_once=20).collect()
    assert 10 <= max(int(x.raw.split()[1]) for x in got if x.raw) <= 20
    assert [x.id for x in got] == [str(i) for i in range(40)]
    assert all(x.raw.split()[0] == f"a{x.id}" and x.calls == 1 for x in got if x.id not in ("7", "9"))
    assert [(x.raw, x.call_error, x.calls) for x in got if x.id in ("7", "9")] == [(None, "RuntimeError: broken", 0), (None, "no body", 0)]


def test_pace_and_deadline():
    now = [0.0]
    waits = []

    def wait(s):
        waits.append(round(s, 6))
        now[0] += s

    pace = Pace(4.0, burst=3, clock=lambda: now[0], wait=wait)
    for _ in range(6):
        pace.take()
    assert waits == [0.25, 0.25, 0.25]  # three at once, then four a second
    now[0] += 100
    for _ in range(3):
        pace.take()
    assert len(waits) == 3
    assert call(lambda b: (503, "x"), "b", 9, wait, deadline=4.0, clock=lambda: now[0]) == (None, "deadline of 4 s: HTTP 503: x", 3)
    Pace(None).take()  # no rate, no wait


def test_detectors_find_their_first_matches(spark):
    import re

    texts = ["gọi 0912 345 678 hay 0987654321", "thư a.b@c.vn, x@y.org", "http://a.b/c https://d.e", "ngày 1/2/2024 rồi 3-4-2024", "lúc 9:05 PM và 23:59", "máy 10.0.0.1 và 1.2.3.4.5", "mã usr-ABC123", "không có gì", "", None, "a:b - c. d@ e"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {x.i: [(m.label, m.value) for m in x.m or []] for x in rows.select("i", detect.first_matches(F.col("t")).alias("m")).collect()}
    plain = {k: re.compile(re.sub(r"^\(\?(i?)U\)", lambda m: "(?i)" if m[1] else "", p)) for k, p in detect.DETECTORS.items()}
    for i, t in enumerate(texts):
        assert got[i] == [(k, p.search(t)[0]) for k, p in plain.items() if t and p.search(t)]


def test_spans_as_a_table_function(spark):
    texts = ["Gọi <PERSON>Ánh 😊</PERSON> lúc <TIME>9:00</TIME>.", "không", "<DATE>1/1/2020</DATE>", None, "<A>x</B> <C>y</C>"]
    tags.register_spans(spark, "spans_of")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows.createOrReplaceTempView("tagged_rows")
    got = sorted(tuple(x) for x in spark.sql("select i, s.* from tagged_rows r, lateral spans_of(r.t) s").collect())
    want = rows.where("t is not null").select("i", F.explode(tags.format_spans(F.col("t"))["entities"]).alias("e")).select("i", "e.*").collect()
    assert got == sorted(tuple(x) for x in want) and len(got) == 4
