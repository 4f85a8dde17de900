"""Similarity, cost and small text functions."""

from __future__ import annotations

import difflib
import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from annolith.functions import blocks

SEQUENCE_LIMIT, NGRAM_LIMIT = 0.84, 0.72


def ngrams(tokens: Column, width: Column) -> Column:
    """Distinct joined n-grams; none for fewer tokens than width."""
    last = F.size(tokens) - width + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, width), " ")))).otherwise(F.array().cast("array<string>"))


def ngram_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays' n-gram sets: bigrams where the shorter has under 8 tokens, else trigrams."""
    width = F.when(F.least(F.size(a), F.size(b)) < 8, 2).otherwise(3)
    x, y = ngrams(a, width), ngrams(b, width)
    common = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(common / (F.size(x) + F.size(y) - common))


def ratio(a: str, b: str, least: float = 0.0) -> float:
    """difflib's ratio, or 0 where a bound already puts it under `least`."""
    if a == b:
        return 1.0
    if not a or not b or 2 * min(len(a), len(b)) < least * (len(a) + len(b)):
        return 0.0
    m = difflib.SequenceMatcher(None, a, b)
    return m.ratio() if least <= 0 or m.quick_ratio() >= least else 0.0


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(blocks.ratios([x or "" for x in a], [y or "" for y in b]))


def best_earlier(least: float):
    """UDF (text, earlier texts) -> the first most similar earlier text's ratio, 0 where none reaches `least`."""

    @F.pandas_udf(DoubleType())
    def run(text: pd.Series, earlier: pd.Series) -> pd.Series:
        return pd.Series([max((ratio(e, t or "", least) for e in (es if es is not None else ())), default=0.0) for t, es in zip(text, earlier, strict=True)])

    return run


def imitation_tokens(text: str | None) -> list[str]:
    """Tagged spans become ENTITY, other tags spaces; NFKC, case-folded word tokens."""
    t = re.sub(r"<([A-Za-z][A-Za-z0-9_]*)>.*?</\1>", " ENTITY ", text or "", flags=re.DOTALL)
    t = unicodedata.normalize("NFKC", re.sub(r"</?[A-Za-z][A-Za-z0-9_]*>", " ", t)).casefold()
    return re.findall(r"\w+", t)


@F.pandas_udf(StringType())
def imitation_form(text: pd.Series) -> pd.Series:
    return text.map(lambda t: " ".join(imitation_tokens(t)))


def token_jaccard(a: list[str], b: list[str]) -> float:
    """ngram_jaccard of token lists."""
    width = 2 if min(len(a), len(b)) < 8 else 3
    x, y = ({tuple(t[i : i + width]) for i in range(len(t) - width + 1)} for t in (a, b))
    return len(x & y) / len(x | y) if x and y else 0.0


@F.pandas_udf(StructType().add("closest", "integer").add("sequence", "double").add("ngram", "double"))
def closest_example(text: pd.Series, examples: pd.Series) -> pd.DataFrame:
    """The example with the greatest of both measures, the first of equal ones; nulls without examples."""
    kept: dict[str, list[str]] = {}

    def tokens(t: str) -> list[str]:
        if t not in kept:
            if len(kept) > 1000:
                kept.clear()
            kept[t] = imitation_tokens(t)
        return kept[t]

    owns, others = [imitation_tokens(t) for t in text], [[tokens(e or "") for e in (es if es is not None else ())] for es in examples]
    measured = iter(blocks.ratios([" ".join(own) for own, es in zip(owns, others, strict=True) for _ in es], [" ".join(e) for es in others for e in es]).tolist())
    out = []
    for own, es in zip(owns, others, strict=True):
        best = (None, None, None)
        for i, other in enumerate(es):
            now = (i, next(measured), token_jaccard(own, other))
            if best[0] is None or max(now[1:]) > max(best[1:]):
                best = now
        out.append(best)
    found = pd.DataFrame(out, columns=["closest", "sequence", "ngram"])
    return found.astype({"closest": "Int32", "sequence": "float64", "ngram": "float64"})


def token_cost(tokens_in: Column, tokens_out: Column, price_in: str = "2.50", price_out: str = "10.00") -> Column:
    """Cost in units of currency at prices per million tokens: 8 decimals, half up."""
    numerator = tokens_in.cast("decimal(18,0)") * F.lit(price_in).cast("decimal(8,2)") + tokens_out.cast("decimal(18,0)") * F.lit(price_out).cast("decimal(8,2)")
    return F.round(numerator.cast("decimal(28,2)") / F.lit(1_000_000).cast("decimal(7,0)"), 8).cast("decimal(20,8)")


def ascii_tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 of the text in lower case."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def output_hash(text: Column) -> Column:
    """What an event names a text by."""
    return F.sha2(text, 256)


def file_stem(name: Column) -> Column:
    """A safe file name: runs of other characters become _, dots and underscores at the ends go; `pii-run` if none is left."""
    safe = F.regexp_replace(F.regexp_replace(name, r"(?U)[^\w.-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(F.length(safe) > 0, safe).otherwise("pii-run")


@functools.cache
def _folds() -> dict[str, str]:
    """Lower-case letters whose case folding is another text."""
    return {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c == c.lower()}


def _ranges(letters: list[str]) -> str:
    """A character class of the letters, with what lies between two that are at most eight apart: few ranges are quick to test."""
    codes = sorted(map(ord, letters))
    starts = [c for before, c in zip([-9, *codes], codes, strict=False) if c - before > 8]
    ends = [c for c, after in zip(codes, [*codes[1:], sys.maxunicode + 9], strict=False) if after - c > 8]
    return "[" + "".join(f"{chr(x)}-{chr(y)}" for x, y in zip(starts, ends, strict=True)) + "]"


def casefold(text: Column) -> Column:
    """Unicode's full case folding, as Python's str.casefold: lower case, then the letters that fold further, where a text has any."""
    single = {x: y for x, y in _folds().items() if len(y) == 1}
    lower = F.lower(text)
    folded = F.translate(lower, "".join(single), "".join(single.values()))
    for x, y in _folds().items():
        if len(y) > 1:
            folded = F.replace(folded, F.lit(x), F.lit(y))
    return F.when(lower.rlike(_ranges(list(_folds()))), folded).otherwise(lower)


#: All white space that Python's strip takes away.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def fold_key(value: Column) -> Column:
    """What two values that count as one have in common: the case-folded value without white space around it."""
    return casefold(F.btrim(value, F.lit(SPACES)))


def capitalize(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def redact(message: Column, secrets: list[str], limit: int = 1000) -> Column:
    """Single-spaced, cut to `limit` characters, secrets replaced."""
    out = F.left(F.trim(F.regexp_replace(message, r"\s+", " ")), F.lit(limit))
    for s in filter(None, secrets):
        out = F.replace(out, F.lit(s), F.lit("[REDACTED]"))
    return out
