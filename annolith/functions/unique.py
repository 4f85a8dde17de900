"""Values that a run never repeats: counter i of a label gives its i-th value, with no look at the values given before.

The values of a template are numbered by the mixed radix of its slots, up to 2^58 of them (slots beyond that are drawn freely).
A keyed permutation puts the numbers in an order of its own: x = l * b + r, with a * b the exact capacity, goes through four
Feistel rounds in which l and r in turn grow by a hash of the other, modulo a or b. Each round can be undone, so no number comes
twice, and as a * b is exact there is nothing to walk around. Variants of a label take turns until the smaller ones are used up.
Beyond a label's capacity its values come again, in another order each time round (`cycle`).
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions import templates
from annolith.functions.detect import luhn_digit
from annolith.plans import values

MOST = 1 << 58
ROUNDS = 4
HEX = 12
LABEL_SCHEMA = "label string, n long, phases array<struct<start:bigint,prev:bigint,alive:array<int>>>"
PART = "struct<at:int,kind:string,text:string,low:bigint,span:bigint,width:int,options:array<string>,stride:bigint,digits:int>"
VARIANT_SCHEMA = f"label string, v int, variant string, a long, b long, parts array<{PART}>"


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        while n % p == 0:
            out.append(p)
            n //= p
        p += 1
    return out + [n] * (n > 1)


def numbered(parts: list[dict]) -> tuple[list[dict], int, int, int]:
    """(parts with stride and digits, capacity, a, b): a part of stride 0 is drawn freely; a * b is the capacity."""
    capacity, primes, out = 1, [], []
    for p in parts:
        span = {"int": p["span"], "pick": len(p["options"]), "hex": 16 ** min(p["width"], HEX)}.get(p["kind"], 0)
        mine = span > 0 and capacity * span <= MOST
        out.append(p | {"stride": capacity if mine else 0, "digits": min(p["width"], HEX) if p["kind"] == "hex" else 0, "span": max(span, 1)})
        if mine:
            capacity *= span
            primes += _primes(span)
    a = b = 1
    for p in sorted(primes, reverse=True):
        a, b = (a * p, b) if a < b else (a, b * p)
    return out, capacity, min(a, b), max(a, b)


@cache
def tables() -> tuple[list[tuple], list[tuple]]:
    """Rows of LABEL_SCHEMA and VARIANT_SCHEMA for all labels: a few for each label, whatever the data."""
    labels, variants = [], []
    for label, made in values.PARSED.items():
        own = [numbered(parts) for _, parts in made]
        order = sorted(range(len(own)), key=lambda v: (own[v][1], v))
        phases, start, prev = [], 0, 0
        for p, v in enumerate(order):
            if own[v][1] > prev:
                phases.append((start, prev, sorted(order[p:])))
                start, prev = start + (own[v][1] - prev) * (len(order) - p), own[v][1]
        labels.append((label, start, phases))
        for v, ((name, _), (parts, _, a, b)) in enumerate(zip(made, own, strict=True)):
            variants.append((label, v, name, a, b, [tuple(p[k] for k in ("at", "kind", "text", "low", "span", "width", "options", "stride", "digits")) for p in parts]))
    return labels, variants


def capacities() -> dict[str, int]:
    """How many values a label has before one comes again."""
    return {label: n for label, n, _ in tables()[0]}


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def with_values(rows: DataFrame, key: list[Column], label: str = "label", counter: str = "counter") -> DataFrame:
    """rows (label, counter 0, 1, ...) with value, variant and cycle, for labels that have templates; other rows are dropped.

    key: what the order of values depends on, such as the run's seed. Rows of equal key and label with other counters have
    other values (without regard to case), as long as cycle is 0. Two joins with constant tables of a few rows a label."""
    spark = rows.sparkSession
    kinds, made = tables()
    names = rows.columns
    rows = rows.withColumnRenamed(label, "_label").withColumn("_i", F.col(counter).cast("long"))
    rows = rows.join(F.broadcast(spark.createDataFrame(kinds, LABEL_SCHEMA).toDF("_label", "_n", "_phases")), "_label")
    rows = rows.withColumns({"cycle": _div(F.col("_i"), F.col("_n")), "_r": F.col("_i") % F.col("_n")})
    rows = rows.withColumn("_f", F.element_at(F.filter("_phases", lambda f: f["start"] <= F.col("_r")), -1))
    rows = rows.withColumn("_r", F.col("_r") - F.col("_f.start")).withColumn("_k", F.size("_f.alive").cast("long"))
    rows = rows.withColumns({"_v": F.get("_f.alive", (F.col("_r") % F.col("_k")).cast("int")), "_j": F.col("_f.prev") + _div(F.col("_r"), F.col("_k"))})
    rows = rows.drop("_n", "_phases", "_f", "_r", "_k")
    rows = rows.join(F.broadcast(spark.createDataFrame(made, VARIANT_SCHEMA).toDF("_label", "_v", "variant", "_a", "_b", "_parts")), ["_label", "_v"])
    key = [F.concat_ws("|", *key, "_label", F.col("_v").cast("string"), F.col("cycle").cast("string"))]
    bits = lambda *k: F.conv(F.substring(F.md5(F.concat_ws("|", *key, *k)), 1, 15), 16, 10).cast("long")
    rows = rows.withColumns({"_x": _div(F.col("_j"), F.col("_b")), "_y": F.col("_j") % F.col("_b")})
    for n in range(ROUNDS):
        mine, other, size = ("_x", "_y", "_a") if n % 2 == 0 else ("_y", "_x", "_b")
        rows = rows.withColumn(mine, (F.col(mine) + bits(F.lit(f"f{n}"), F.col(other).cast("string"))) % F.col(size))
    rows = rows.withColumn("_x", F.col("_x") * F.col("_b") + F.col("_y"))

    def piece(p: Column, i: Column) -> Column:
        fixed, free = p["stride"] > 0, F.md5(F.concat_ws("|", *key, F.col("_j").cast("string"), i.cast("string")))
        digit = F.when(fixed, _div(F.col("_x"), F.greatest(p["stride"], F.lit(1))) % F.greatest(p["span"], F.lit(1))).otherwise(F.conv(F.substring(free, 1, 15), 16, 10).cast("long") % F.greatest(p["span"], F.lit(1)))
        number = (digit + p["low"]).cast("string")
        return (
            F.when(p["kind"] == "text", p["text"])
            .when(p["kind"] == "int", F.when(p["width"] > 0, F.lpad(number, p["width"], F.lit("0"))).otherwise(number))
            .when(p["kind"] == "pick", F.get(p["options"], digit.cast("int")))
            .when(p["kind"] == "hex", F.concat(F.lpad(F.lower(F.hex(digit)), p["digits"], F.lit("0")), F.substr(free, F.lit(16), p["width"] - p["digits"])))
            .otherwise("")
        )

    # a function of the parts, not one expression for each: code of all templates' parts would not compile
    rows = rows.withColumn("value", F.array_join(F.transform("_parts", piece), ""))
    luhn = F.element_at("_parts", -1)["kind"] == "luhn"
    rows = rows.withColumn("value", F.when(luhn, F.concat("value", luhn_digit(F.col("value")))).otherwise(F.col("value")))
    return rows.withColumnRenamed("_label", label).select(*names, "value", "variant", "cycle")


def sql_values(source: str, key: str) -> str:
    """CTEs for DuckDB that end in unique_values: the rows of source (label, counter) with value, variant and cycle; key: varchar expressions."""
    kinds, made = tables()
    text = lambda s: "'" + s.replace("'", "''") + "'"
    labels = ", ".join(f"('{label}', {n}::bigint, [{', '.join(f"{{'start': {s}::bigint, 'prev': {p}::bigint, 'alive': {alive}}}" for s, p, alive in phases)}])" for label, n, phases in kinds)
    part = lambda p: "{{'at': {}, 'kind': '{}', 'text': {}, 'low': {}::bigint, 'span': {}::bigint, 'width': {}, 'options': [{}]::varchar[], 'stride': {}::bigint, 'digits': {}}}".format(p[0], p[1], text(p[2]), *p[3:6], ", ".join(map(text, p[6])), *p[7:])
    variants = ", ".join(f"('{label}', {v}, '{name}', {a}::bigint, {b}::bigint, [{', '.join(map(part, parts))}])" for label, v, name, a, b, parts in made)
    bits = lambda k: f"cast('0x' || substr(md5(concat_ws('|', {key}, label, v, cycle, {k})), 1, 15) as bigint)"
    steps = []
    for n in range(ROUNDS):
        mine, other, size = ("x", "y", "a") if n % 2 == 0 else ("y", "x", "b")
        steps.append(f"uv_{n} as (select * exclude ({mine}), ({mine} + {bits(f"'f{n}', {other}")}) % {size} as {mine} from {'uv_j' if n == 0 else f'uv_{n - 1}'})")
    free = f"md5(concat_ws('|', {key}, label, v, cycle, j, i - 1))"
    digit = f"case when p.stride > 0 then z // p.stride % p.span else cast('0x' || substr({free}, 1, 15) as bigint) % greatest(p.span, 1) end"
    number = f"cast({digit} + p.low as varchar)"
    one = f"""case p.kind when 'text' then p.text when 'int' then case when p.width > 0 then lpad({number}, p.width, '0') else {number} end
              when 'pick' then p.options[cast({digit} as int) + 1] when 'hex' then lpad(lower(to_hex({digit})), p.digits, '0') || substr({free}, 16, p.width - p.digits) else '' end"""
    twice = "case when i % 2 = 1 then case when cast(c as int) * 2 > 9 then cast(c as int) * 2 - 9 else cast(c as int) * 2 end else cast(c as int) end"
    return f"""
     uv_l(label, n, phases) as (values {labels}), uv_t(label, v, variant, a, b, parts) as (values {variants}),
     uv_p as (select s.*, counter // n as cycle, counter % n as r, phases from {source} s join uv_l using (label)),
     uv_f as (select * exclude (phases), list_filter(phases, lambda f: f.start <= r)[-1] as f from uv_p),
     uv_v as (select * exclude (r, f), f.alive[(r - f.start) % len(f.alive) + 1] as v, f.prev + (r - f.start) // len(f.alive) as j from uv_f),
     uv_j as (select *, j // b as x, j % b as y from uv_v join uv_t using (label, v)),
     {", ".join(steps)},
     uv_z as (select *, x * b + y as z from uv_{ROUNDS - 1}),
     uv_w as (select *, array_to_string(list_transform(parts, lambda p, i: {one}), '') as made from uv_z),
     unique_values as (select * exclude (made, parts, a, b, x, y, z, j, v), case when parts[-1].kind = 'luhn' then made || cast((10 - list_sum(list_transform(string_split(reverse(made), ''), lambda c, i: {twice})) % 10) % 10 as int) else made end as value from uv_w)"""
