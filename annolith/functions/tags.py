"""Inline tags: `<LABEL>value</LABEL>` to clean text and end-exclusive spans in code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from annolith.functions.text import casefold

#: Fixed patterns: a tagged value as the validator reads it, as the formatter reads it, and any tag at all.
TAGGED = r"(?s)<([A-Z][A-Z0-9_]*)>(.*?)</\1>"
PLAIN_TAGGED = r"<([A-Z][A-Z0-9_]*)>([^<>]+)</\1>"
ANY_TAG = r"</?[A-Za-z][A-Za-z0-9_]*>"
ANY_TAGGED = r"(?s)<([A-Za-z][A-Za-z0-9_]*)>.*?</\1>"


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, ANY_TAG, "")


def tagged_pairs(text: Column, pattern: str = TAGGED) -> Column:
    """array<struct<label, value>> in order of occurrence."""
    found = lambda i: F.regexp_extract_all(text, F.lit(pattern), F.lit(i))
    return F.arrays_zip(found(1).alias("label"), found(2).alias("value"))


def has_residual_tag(text: Column) -> Column:
    """Whether a malformed or nested tag is left once the valid ones gave way to their values."""
    return F.regexp_replace(text, TAGGED, "$2").rlike(ANY_TAG)


def format_spans(text: Column) -> Column:
    """struct<text, entities: array<struct<label, start, end, text>>> of well-formed tagged text."""
    parts = F.split(text, PLAIN_TAGGED, -1)
    pairs = tagged_pairs(text, PLAIN_TAGGED)
    empty = F.lit(None).cast("array<struct<label:string,start:int,end:int,text:string>>")
    first = F.struct(F.lit(0).alias("n"), F.length(F.element_at(parts, 1)).alias("at"), F.coalesce(empty, F.array().cast("array<struct<label:string,start:int,end:int,text:string>>")).alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        end = acc["at"] + F.length(pair["value"])
        span = F.struct(pair["label"].alias("label"), acc["at"].alias("start"), end.alias("end"), pair["value"].alias("text"))
        return F.struct((acc["n"] + 1).alias("n"), (end + F.length(F.element_at(parts, acc["n"] + 2))).alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    spans = F.aggregate(pairs, first, step, lambda acc: acc["spans"])
    return F.struct(F.regexp_replace(text, PLAIN_TAGGED, "$2").alias("text"), spans.alias("entities"))


def register_spans(spark: SparkSession, name: str = "spans") -> None:
    """The SQL table function name(tagged_text): a row (label, start, end, text) for each span, for lateral joins. No Python runs."""
    quoted = PLAIN_TAGGED.replace("\\", "\\\\")
    found = lambda i: f"regexp_extract_all(tagged, '{quoted}', {i})"
    parts, span = f"split(tagged, '{quoted}', -1)", "named_struct('label', p.label, 'start', acc.at, 'end', acc.at + length(p.value), 'text', p.value)"
    state = "named_struct('n', {}, 'at', {}, 'found', {})".format
    first = state("0", f"length(element_at({parts}, 1))", "cast(array() as array<struct<label:string,start:int,end:int,text:string>>)")
    step = state("acc.n + 1", f"acc.at + length(p.value) + length(element_at({parts}, acc.n + 2))", f"array_append(acc.found, {span})")
    spark.sql(f"""
        create or replace temporary function {name}(tagged string) returns table (label string, start int, `end` int, text string)
        return select s.label, s.start, s.`end`, s.text from (
            select explode(aggregate(zip_with({found(1)}, {found(2)}, (l, v) -> named_struct('label', l, 'value', v)), {first}, (acc, p) -> {step}, acc -> acc.found)) as s)
    """)


def format_error(text: Column, entities: Column, allowed: Column) -> Column:
    """Why a text can't be formatted, or null: tags left over, a label that is not allowed, metadata that differs, no text."""
    pairs = tagged_pairs(text, PLAIN_TAGGED)
    clean = F.regexp_replace(text, PLAIN_TAGGED, "$2")
    pair = lambda x: F.struct(x["label"].alias("label"), x["value"].alias("value"))
    return (
        F.when(clean.rlike("[<>]"), "nested, unknown or malformed tag")
        .when(F.size(F.array_except(F.transform(pairs, lambda x: x["label"]), allowed)) > 0, "label is not allowed")
        .when(F.array_sort(F.transform(pairs, pair)) != F.array_sort(F.transform(entities, pair)), "metadata differs from tags")
        .when(F.length(F.trim(clean)) == 0, "text is empty")
    )


def spans_hold(text: Column, entities: Column) -> Column:
    """Every span has a positive length, matches the text, and overlaps no other."""
    fits = F.forall(entities, lambda e: (e["end"] > e["start"]) & (F.substr(text, e["start"] + 1, e["end"] - e["start"]) == e["text"]))
    ordered = F.array_sort(F.transform(entities, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"))))
    apart = F.forall(F.zip_with(F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))), F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))), lambda a, b: a["end"] <= b["start"]), lambda ok: F.coalesce(ok, F.lit(True)))
    return fits & apart


def skeleton(text: Column, decoys: Column | None = None, fold: Callable[[Column], Column] = casefold) -> Column:
    """Sentence skeleton: tagged spans become `<label>`, decoy values (longest first) `<decoy>`; case-folded, single spaces."""
    out = F.regexp_replace(text, ANY_TAGGED, "<$1>")
    if decoys is not None:
        longest = F.array_sort(F.transform(F.filter(decoys, lambda d: F.length(d) > 0), lambda d: F.struct((-F.length(d)).alias("n"), d.alias("d"))))
        out = F.aggregate(longest, out, lambda acc, d: F.replace(acc, d["d"], F.lit("<decoy>")))
    return F.trim(F.regexp_replace(fold(out), r"\s+", " "))


def occurrences(text: Column, value: Column) -> Column:
    """Non-overlapping occurrences; none for an empty value."""
    return F.when(F.length(value) > 0, ((F.length(text) - F.length(F.replace(text, value, F.lit("")))) / F.length(value)).cast("int")).otherwise(0)


def occurrence_contexts(text: Column, value: Column) -> Column:
    """For each occurrence of value in the tag-free text, its sentence: bounded by . ! ? ; or a line end, the right one kept."""
    clean = strip_tags(text)
    mark = F.lit("\ue000")  # stands for the value, so that its own delimiters bound nothing
    marked = F.replace(clean, value, mark)
    pieces = F.split(marked, "\ue000", -1)
    n = F.size(pieces) - 1
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")

    def sentence(i: Column) -> Column:
        before = F.array_join(F.slice(pieces, 1, i), "\ue000")
        after = F.array_join(F.slice(pieces, i + 1, F.size(pieces)), "\ue000")
        left = F.regexp_extract(F.replace(before, mark, value), r"[^.!?;\n]*\z", 0)
        right = F.regexp_extract(F.replace(after, mark, value), r"^[^.!?;\n]*[.!?;\n]?", 0)
        return strip(F.concat(left, value, right))

    return F.when((F.length(value) > 0) & (n > 0), F.transform(F.sequence(F.lit(1), n), sentence)).otherwise(F.array().cast("array<string>"))


def preceding(text: Column, value: Column, width: int = 30) -> Column:
    """The `width` characters before each occurrence of value in the tag-free text."""
    pieces = F.split(F.replace(strip_tags(text), value, F.lit("\ue000")), "\ue000", -1)
    n = F.size(pieces) - 1
    before = lambda i: F.right(F.array_join(F.slice(pieces, 1, i), "\ue000"), F.lit(width))
    return F.when((F.length(value) > 0) & (n > 0), F.transform(F.sequence(F.lit(1), n), lambda i: F.replace(before(i), F.lit("\ue000"), value))).otherwise(F.array().cast("array<string>"))


def window_context(text: Column, value: Column, width: int = 80) -> Column:
    """The first occurrence of value in the tag-free text with `width` characters on either side, trimmed; null without one."""
    clean = strip_tags(text)
    at = F.instr(clean, value)
    start = F.greatest(at - width, F.lit(1))
    return F.when((at > 0) & (F.length(value) > 0), F.regexp_replace(F.substr(clean, start, at + F.length(value) + width - start), r"^\s+|\s+$", ""))
