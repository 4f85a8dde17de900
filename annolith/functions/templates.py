"""Value templates: text with slots, drawn as columns, as SQL, and matched by a pattern, all from one parsed form.

Slots: `{5d}` five digits (15 at most), `{1-28}` a whole number, `{1-28:2}` the same with zeros in front, `{16h}` hex digits
(32 at most), `{name}` a member of the list of that name, and at the end `{luhn}`, the check digit of all before. A slot's
draw is the md5 of its key and its place in the template, so Spark and any SQL engine with md5 draw the same value.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from annolith.functions.detect import luhn_digit

PART = "struct<at:int,kind:string,text:string,low:bigint,span:bigint,width:int,options:array<string>>"
SLOT = re.compile(r"\{([^{}]+)\}")


def parse(template: str, lists: dict[str, list[str]]) -> list[dict]:
    """The template's parts in order; raises KeyError for a list that isn't there."""
    out: list[dict] = []
    for i, piece in enumerate(SLOT.split(template)):
        part = {"at": len(out), "kind": "text", "text": piece, "low": 0, "span": 1, "width": 0, "options": []}
        if i % 2 == 0:
            if piece:
                out.append(part)
            continue
        if m := re.fullmatch(r"(\d+)d", piece):
            part |= {"kind": "int", "text": "", "span": 10 ** int(m[1]), "width": int(m[1])}
        elif m := re.fullmatch(r"(\d+)h", piece):
            part |= {"kind": "hex", "text": "", "width": int(m[1])}
        elif m := re.fullmatch(r"(\d+)-(\d+)(?::(\d+))?", piece):
            part |= {"kind": "int", "text": "", "low": int(m[1]), "span": int(m[2]) - int(m[1]) + 1, "width": int(m[3] or 0)}
        elif piece == "luhn":
            part |= {"kind": "luhn", "text": ""}
        else:
            part |= {"kind": "pick", "text": "", "options": lists[piece]}
        out.append(part)
    return out


def pattern(parts: list[dict]) -> str:
    """A regular expression that a template's values match whole."""
    each = {
        "text": lambda p: re.sub(r"([^\w\s])", r"\\\1", p["text"]),
        "int": lambda p: f"[0-9]{{{p['width']}}}" if p["width"] else "[0-9]+",
        "hex": lambda p: f"[0-9a-f]{{{p['width']}}}",
        "pick": lambda p: "(" + "|".join(re.sub(r"([^\w\s])", r"\\\1", x) for x in p["options"]) + ")",
        "luhn": lambda p: "[0-9]",
    }
    return "^" + "".join(each[p["kind"]](p) for p in parts) + "$"


def bound(value: Column, f) -> Column:
    """f(value) with value computed once and named once in the plan."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def drawn(parts: Column, *key) -> Column:
    """The value of a template (array of PART) for a key."""
    key = [k if isinstance(k, Column) else F.lit(str(k)) for k in key]

    def piece(p: Column) -> Column:
        # each branch has its own hash, so that a part takes one at most and text none
        h = F.md5(F.concat_ws("|", *key, p["at"].cast("string")))
        bits = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
        number = (bits % p["span"] + p["low"]).cast("string")
        return (
            F.when(p["kind"] == "text", p["text"])
            .when(p["kind"] == "int", F.when(p["width"] > 0, F.lpad(number, p["width"], F.lit("0"))).otherwise(number))
            .when(p["kind"] == "pick", F.get(p["options"], (bits % F.size(p["options"])).cast("int")))
            .when(p["kind"] == "hex", F.substr(h, F.lit(1), p["width"]))
            .otherwise("")
        )

    def whole(made: Column) -> Column:
        return F.when(F.exists(parts, lambda p: p["kind"] == "luhn"), bound(made, lambda m: F.concat(m, luhn_digit(m)))).otherwise(made)

    return bound(F.array_join(F.transform(parts, piece), ""), whole)


def drawn_batch(parts: list[tuple], before: str, keys: list[str | None]) -> pa.Array:
    """The values of a template (rows of PART) for many keys, as `drawn` gives them for before and each key: a column of an Arrow task."""
    pieces, said = [], [b"" if k is None else f"{k}|".encode() for k in keys]  # a null key is left out, as concat_ws does
    head = f"{before}|".encode()
    for at, kind, text, low, span, width, options in parts:
        if kind == "text":
            pieces.append(pa.scalar(text))
            continue
        if kind == "luhn":
            made = pc.binary_join_element_wise(*pieces, pa.array([""] * len(keys)), "").to_pylist()
            pieces.append(pa.array([_luhn(x) for x in made], pa.string()))
            continue
        tail = str(at).encode()
        if kind == "hex":
            pieces.append(pa.array([hashlib.md5(head + k + tail).hexdigest()[:width] for k in said], pa.string()))
            continue
        # the first 15 hex digits: 60 bits
        bits = (np.frombuffer(b"".join([hashlib.md5(head + k + tail).digest() for k in said]), ">u8")[::2] >> np.uint64(4)).astype(np.int64)
        if kind == "pick":
            pieces.append(pa.array(options, pa.string()).take(pa.array(bits % len(options))))
        else:
            number = pa.array(bits % span + low).cast(pa.string())
            pieces.append(pc.utf8_lpad(number, width, "0") if width else number)
    return pc.binary_join_element_wise(*pieces, pa.array([""] * len(keys)), "")


def _luhn(payload: str) -> str:
    """luhn_digit of one string."""
    twice = [2 * int(c) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(payload))]
    return str(-sum(d - 9 if d > 9 else d for d in twice) % 10)


def sql_parts(parts: list[dict]) -> str:
    """A template as a DuckDB list of structs."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    options = lambda p: "[" + ", ".join(map(text, p["options"])) + "]::varchar[]"
    return "[" + ", ".join(f"{{'at': {p['at']}, 'kind': '{p['kind']}', 'text': {text(p['text'])}, 'low': {p['low']}::bigint, 'span': {p['span']}::bigint, 'width': {p['width']}, 'options': {options(p)}}}" for p in parts) + "]"


def sql_drawn(parts: str, key: str) -> str:
    """DuckDB expression of `drawn`: parts is a list column, key a comma-separated list of varchar expressions."""
    h = f"md5(concat_ws('|', {key}, cast(i - 1 as varchar)))"
    bits = f"cast('0x' || substr({h}, 1, 15) as bigint)"
    number = f"cast({bits} % p.span + p.low as varchar)"
    one = f"case p.kind when 'text' then p.text when 'int' then case when p.width > 0 then lpad({number}, p.width, '0') else {number} end when 'hex' then substr({h}, 1, p.width) when 'pick' then p.options[cast({bits} % len(p.options) as int) + 1] else '' end"
    value = f"array_to_string(list_transform({parts}, lambda p, i: {one}), '')"
    twice = "case when j % 2 = 1 then case when cast(c as int) * 2 > 9 then cast(c as int) * 2 - 9 else cast(c as int) * 2 end else cast(c as int) end"
    digit = f"cast((10 - list_sum(list_transform(string_split(reverse({value}), ''), lambda c, j: {twice})) % 10) % 10 as int)"
    return f"case when list_contains(list_transform({parts}, lambda p: p.kind), 'luhn') then {value} || cast({digit} as varchar) else {value} end"
