"""Counter-based randomness: a draw is a function of (seed, axis, counter), so any row can be recomputed alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bits(*key) -> Column:
    """32 random bits as a long."""
    parts = [k if isinstance(k, Column) else F.lit(str(k)) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def uniform(*key) -> Column:
    """A double in [0, 1)."""
    return bits(*key) / F.lit(4294967296.0)


def between(lo: int, hi: int, *key) -> Column:
    """A long from lo to hi, both included."""
    return bits(*key) % (hi - lo + 1) + lo


def choice(values: list, *key) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (bits(*key) % len(values) + 1).cast("int"))


def weighted(weights: dict[str, float], *key) -> Column:
    """A key of weights; they add up to 1."""
    u, total, names = uniform(*key), 0.0, list(weights)
    out = F.lit(names[-1])
    for name in reversed(names[:-1]):
        total = sum(weights[n] for n in names[: names.index(name) + 1])
        out = F.when(u < F.lit(total), name).otherwise(out)
    return out


def shuffled(values: Column, *key) -> Column:
    """The array's elements in an order that depends on the key alone."""
    parts = [k if isinstance(k, Column) else F.lit(str(k)) for k in key]
    ranked = F.transform(values, lambda v: F.struct(F.md5(F.concat_ws("|", *parts, v)).alias("h"), v.alias("v")))
    return F.transform(F.array_sort(ranked), lambda x: x["v"])


def bag(values: list[str], counter: Column, *key) -> Column:
    """Quota axis: counter 1, 2, ... goes through all values once before any comes again; each bag has its own order."""
    k, at = len(values), counter - 1
    return F.element_at(shuffled(F.array(*(F.lit(v) for v in values)), *key, F.floor(at / k).cast("string")), (at % k + 1).cast("int"))


def digits(n: int, *key) -> Column:
    """A string of n digits."""
    blocks = [F.lpad((bits(*key, f"d{i}") % 1_000_000).cast("string"), 6, "0") for i in range(-(-n // 6))]
    return F.substring(F.concat(*blocks), 1, n)
