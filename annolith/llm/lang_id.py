"""Language identification by fusing evidence as Bayes' rule has it.

Text: byte-trigram log likelihoods of each language, learnt from labelled texts, plus a flat background language `und`.
Markup and address: P(declared language | language) and P(address suffix | language), counted over all rows by grouped
aggregation of the text's own verdicts and smoothed. Host: a prior of languages for each host, smoothed towards its
registered domain's, and that towards the whole table's; a row's own vote is taken out of the counts.
The posterior is the normalised product; the text's part is tempered, since neighbouring trigrams are not independent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import cut, lean, runs, utf8
from annolith.llm.jaccard_join import LOWER

#: Labelled texts that the trigram model is learnt from, at most; the sample is drawn by a hash over the whole table.
FIT_ROWS = 20_000
BUCKETS = 1 << 16
UND = "und"
#: Trigrams beyond which a longer text adds no certainty, and the weight of each.
TEMPER, WEIGHT = 400, 0.25
KAPPA = 20.0
SMOOTH = 0.5
#: Hosts (domains, declared values) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000

_LETTER = np.array([97 <= i <= 122 or i >= 128 for i in range(256)])


def _trigrams(low: np.ndarray) -> np.ndarray:
    a = np.where(_LETTER[low], low, 32).astype(np.uint32)
    h = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def _chunks(column):
    data, offsets = utf8(column)
    for a, b in runs(offsets, 1 << 20):
        part, own = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        yield a, b, part, own


def _count(batches):
    out = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        totals: dict[str, np.ndarray] = {}
        for a, b, part, own in _chunks(batch.column(1)):
            if len(part) < 3:
                continue
            t = _trigrams(part)
            for i in range(a, b):
                s = t[own[i - a] : max(own[i - a], own[i - a + 1] - 2)]
                totals.setdefault(langs[i], np.zeros(BUCKETS, np.int64))
                totals[langs[i]] += np.bincount(s, minlength=BUCKETS)
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], schema=out)


class TextModel:
    """log P(trigram | language) for each language, `und` last."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = [*langs, UND]
        p = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
        self.logs = np.log(np.vstack([p, np.full((1, BUCKETS), 1.0 / BUCKETS)])).astype(np.float32)


def fit_text(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> TextModel:
    """Trigram counts by language from fit_rows rows at most; rows without language or text teach nothing."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    share = fit_rows / max(rows.count(), fit_rows)
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
    got = rows.mapInArrow(lean(_count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    for i, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        counts[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    return TextModel(langs, counts)


def _scores(model, names: list[str]):
    out = pa.schema([(n, pa.int64() if n == "key" else pa.string()) for n in names] + [("grams", pa.int64()), ("ll", pa.list_(pa.float64()))])

    def run(batches):
        logs = model.value.logs
        width = len(logs)
        for batch in batches:
            total, grams = np.zeros((batch.num_rows, width)), np.zeros(batch.num_rows, np.int64)
            for a, b, part, own in _chunks(batch.column("text")):
                if len(part) < 3:
                    continue
                t = _trigrams(part)
                ink = _LETTER[part]
                letters = np.concatenate(([0], np.cumsum(ink)))
                lo = np.minimum(own[:-1], len(t))
                hi = np.maximum(lo, np.minimum(own[1:] - 2, len(t)))
                sums = np.zeros(len(t) + 1)
                for i in range(width):
                    np.cumsum(logs[i][t], dtype=np.float64, out=sums[1:])
                    total[a:b, i] = sums[hi] - sums[lo]
                grams[a:b] = np.where(letters[own[1:]] - letters[own[:-1]] > 0, hi - lo, 0)
            tempered = total * (WEIGHT * np.minimum(grams, TEMPER) / np.maximum(grams, 1))[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(tempered.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(grams), lists], schema=out)

    return run


def _small(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    return df.join(F.broadcast(other) if other.count() <= BROADCAST_ROWS else other, on, "left")


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """rows (key, text, declared, suffix, host) to (key, lang, probability, text_lang, declared, suffix, host, known).

    known is false where the text has no letters, `und` wins or the probability is under a half; a model without any language
    knows nothing better than `und`, so with it every text that has letters counts as known. A null or empty declared value,
    suffix or host is no evidence. One row out for each row in; texts are scored whole."""
    spark, langs = rows.sparkSession, model.langs
    n = len(langs)
    clean = lambda c: F.nullif(F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))), F.lit(""))
    rows = rows.select("key", "text", *(clean(c).alias(c) for c in ("declared", "suffix", "host")))
    schema = "key long, declared string, suffix string, host string, grams long, ll array<double>"
    scored = rows.mapInArrow(lean(_scores(spark.sparkContext.broadcast(model), ["key", "declared", "suffix", "host"])), schema)
    best = F.expr("cast(array_position(ll, array_max(ll)) - 1 as int)")
    scored = cut(scored.withColumn("own", F.when(F.col("grams") > 0, best)).withColumn("domain", F.expr("if(host is null, null, array_join(slice(split(host, '[.]'), greatest(1, size(split(host, '[.]')) - 1), 2), '.'))")), "scores")
    votes = scored.where("own is not null")

    def counts(*by: str) -> DataFrame:
        each = [F.sum((F.col("own") == i).cast("long")).alias(f"n{i}") for i in range(n)]
        return votes.where(" and ".join(f"{c} is not null" for c in by) or "true").groupBy(*by).agg(*each)

    all_ = counts().first()
    whole = [float(all_[f"n{i}"] or 0) for i in range(n)]
    sum_ = sum(whole) or 1.0
    base = [(w + 1.0) / (sum_ + n) for w in whole]
    out = scored
    for name in ("declared", "suffix"):
        found = counts(name)
        found = found.select(name, F.array(*(F.log((F.col(f"n{i}") + F.lit(SMOOTH)) / F.lit(whole[i] + 10 * SMOOTH)) for i in range(n))).alias(f"{name}_log"))
        out = _small(out, found, name)
    domain = counts("domain")
    out = _small(out, domain.select("domain", F.array(*(F.col(f"n{i}") for i in range(n))).alias("domain_n")), "domain")
    host = counts("host")
    out = _small(out, host.select("host", F.array(*(F.col(f"n{i}") for i in range(n))).alias("host_n")), "host")
    zeros = F.array(*(F.lit(0).cast("long") for _ in range(n)))
    mine = lambda i: F.when(F.col("own") == i, 1).otherwise(0)
    without = lambda c, i: F.greatest(F.coalesce(F.col(c), zeros)[i] - F.when(F.col(c).isNotNull(), mine(i)).otherwise(0), F.lit(0))
    total = lambda c: sum((without(c, i) for i in range(n)), F.lit(0.0))
    out = out.withColumns({"dt": total("domain_n"), "ht": total("host_n")})
    score = []
    for i in range(n):
        domain_p = (without("domain_n", i) + F.lit(KAPPA * base[i])) / (F.col("dt") + F.lit(KAPPA))
        host_p = (without("host_n", i) + F.lit(KAPPA) * domain_p) / (F.col("ht") + F.lit(KAPPA))
        flat = F.lit(0.0)
        score.append(F.when(F.col("grams") > 0, F.col("ll")[i]).otherwise(flat) + F.log(host_p) + F.coalesce(F.col("declared_log")[i], flat) + F.coalesce(F.col("suffix_log")[i], flat))
    out = out.withColumn("score", F.array(*score))
    out = out.withColumn("top", F.array_max("score")).withColumn("at", F.expr("cast(array_position(score, top) as int)"))
    names = F.array(*(F.lit(x) for x in langs))
    share = F.lit(1.0) / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    out = out.select("key", F.element_at(names, F.col("at")).alias("lang"), share.alias("probability"), F.element_at(names, F.col("own") + 1).alias("text_lang"), "declared", "suffix", "host", "grams")
    known = (F.col("grams") > 0) & (F.col("lang") != UND) & (F.col("probability") >= 0.5) if n > 1 else F.col("grams") > 0
    return out.withColumn("known", known).drop("grams")


def page_rows(pages: DataFrame) -> DataFrame:
    """(key, text, declared, suffix, host) of pages (page_id, url, html): visible text, the html element's language, the host's last label."""
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " ")
    declared = F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("key"), text.alias("text"), declared.alias("declared"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), host.alias("host"))
