"""Calls to generating and judging models: retries, answers as rows, the strict contract of verdicts, offline stand-ins.

A transport is send(body: str) -> (status, answer text); it raises OSError where the host can't be reached. Failures are
rows with an error, never exceptions, so one bad call doesn't end a job of many."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.operators.verify import ISSUE

# Statuses worth another try, and the longest wait in seconds.
RETRIED = (408, 429, 500, 502, 503, 504)
LONGEST_WAIT = 8
STATUSES = ("PASS", "FIXABLE", "REGENERATE", "REJECTED")
SEVERITIES = ("low", "medium", "high", "critical")
VERDICT = f"struct<status:string,score:int,issues:array<{ISSUE}>>"
VERDICT_KEYS, ISSUE_KEYS = ("status", "score", "issues"), ("type", "severity", "field", "reason")


class Pace:
    """A token bucket for the calls of a task's threads: `rate` a second on average, `burst` at once."""

    def __init__(self, rate: float | None, burst: int = 1, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        self.rate, self.clock, self.wait, self.lock = rate, clock, wait, threading.Lock()
        self.full = max(0, burst - 1) / rate if rate else 0.0
        self.free = clock() - self.full

    def take(self) -> None:
        """Waits until a call may begin."""
        if not self.rate:
            return
        with self.lock:
            now = self.clock()
            begin = max(self.free, now - self.full)
            self.free = begin + 1 / self.rate
        if begin > now:
            self.wait(begin - now)


def call(
    send: Callable[[str], tuple[int, str]], body: str, retries: int = 3, wait: Callable[[float], None] = time.sleep, pace: Pace | None = None, deadline: float | None = None, clock: Callable[[], float] = time.monotonic,
) -> tuple[str | None, str | None, int]:
    """(answer, error, calls made): tries again after RETRIED statuses and unreachable hosts, waiting 1, 2, 4, 8, 8... seconds.

    deadline: seconds after which no other try begins."""
    error, until = None, None if deadline is None else clock() + deadline
    for n in range(retries + 1):
        if pace:
            pace.take()
        try:
            status, text = send(body)
            if 200 <= status < 300:
                return text, None, n + 1
            error = f"HTTP {status}: {text}"
            if status not in RETRIED:
                return None, error, n + 1
        except OSError as e:
            error = f"unreachable: {e}"
        if n < retries:
            pause = min(2**n, LONGEST_WAIT)
            if until is not None and clock() + pause >= until:
                return None, f"deadline of {deadline:g} s: {error}", n + 1
            wait(pause)
    return None, error, retries + 1


def answers(
    rows: DataFrame, body: Column, connect: Callable[[], Callable[[str], tuple[int, str]]], retries: int = 3, wait: Callable[[float], None] = time.sleep,
    at_once: int = 8, rate: float | None = None, burst: int = 1, deadline: float | None = None,
) -> DataFrame:
    """rows with raw, call_error and calls; connect() makes a transport once for each thread of a task.

    at_once rows of a task wait for their answers at a time, begun in order and given back in order; a task begins `rate` calls
    a second at most (`burst` at once), so a cluster begins as many as it has task slots times that. An infrastructure error, a
    passed deadline (seconds a row) and an error of the transport's own leave raw null: such a row's attempt isn't used up and
    its candidate can be sent again. A null body is not sent."""

    def run(frames):
        pace, own = Pace(rate, burst, wait=wait), threading.local()

        def one(b):
            if b is None:
                return None, "no body", 0
            try:
                if not hasattr(own, "send"):
                    own.send = connect()
                return call(own.send, b, retries, wait, pace, deadline)
            except Exception as e:  # noqa: BLE001  a transport's fault is this row's error and no other's
                return None, f"{type(e).__name__}: {e}", 0

        with ThreadPoolExecutor(at_once) as pool:
            for pdf in frames:
                got = list(pool.map(one, pdf["_body"]))
                out = pdf.drop(columns="_body")
                yield out.assign(raw=pd.Series([g[0] for g in got], dtype=object), call_error=pd.Series([g[1] for g in got], dtype=object), calls=[g[2] for g in got])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", raw string, call_error string, calls int"
    return rows.withColumn("_body", body).mapInPandas(run, schema)


def parse_verdict(content: Column) -> Column:
    """struct<status, score, issues, error> of a judge's JSON object; error names the first breach of the contract.

    Exactly the keys status, score and issues, a known status, a score of 0 to 100, issues with exactly their four keys and
    a known severity, and a decision that agrees with its issues."""
    verdict = F.from_json(content, VERDICT)
    keys, listed = F.json_object_keys(content), F.from_json(F.get_json_object(content, "$.issues"), "array<string>")
    exact = lambda have, want: F.array_sort(have) == F.array(*(F.lit(x) for x in sorted(want)))
    issues = F.coalesce(verdict["issues"], F.array().cast(f"array<{ISSUE}>"))
    severities = F.transform(issues, lambda i: i["severity"])
    status = verdict["status"]
    from annolith.operators.flow import decision_error

    error = (
        F.when(keys.isNull(), "the answer is no object")
        .when(~exact(keys, VERDICT_KEYS), "the verdict's keys differ")
        .when(status.isNull() | ~status.isin(*STATUSES), "unknown status")
        .when(verdict["score"].isNull() | ~verdict["score"].between(0, 100), "the score is not 0 to 100")
        .when(listed.isNull(), "issues is no list")
        .when(F.exists(listed, lambda i: ~F.coalesce(exact(F.json_object_keys(i), ISSUE_KEYS), F.lit(False))), "an issue's keys differ")
        .when(F.exists(severities, lambda s: s.isNull() | ~s.isin(*SEVERITIES)), "unknown severity")
        .otherwise(decision_error(status, severities))
    )
    return F.struct(status.alias("status"), verdict["score"].alias("score"), issues.alias("issues"), error.alias("error"))


def error_detail(body: Column, secrets: list[str]) -> Column:
    """`code: message` of a failed call's JSON body, or the body itself; 8,192 characters are read, secrets are replaced."""
    from annolith.functions.text import redact

    head = F.left(body, F.lit(8192))
    code, message = (F.coalesce(F.get_json_object(head, f"$.error.{n}"), F.get_json_object(head, f"$.{n}")) for n in ("code", "message"))
    return redact(F.coalesce(F.nullif(F.concat_ws(": ", code, message), F.lit("")), head, F.lit("")), secrets)


def offline_judge(rows: DataFrame) -> DataFrame:
    """Every candidate passes, at no cost."""
    return rows.withColumn("verdict", F.struct(F.lit("PASS").alias("status"), F.array().cast(f"array<{ISSUE}>").alias("issues")))


def offline_repair(rows: DataFrame) -> DataFrame:
    """The candidate as it is."""
    return rows
