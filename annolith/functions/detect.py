"""Structured values: detectors, format checks and the labels a bare value could stand for."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One pattern for each detected label, Java syntax, Unicode classes.
DETECTORS = {
    "EMAIL": r"(?U)(?<![\w.+-])[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}(?![\w-])",
    "PHONE": r"(?U)(?<!\d)(?:\+?84|0)[ .-]?(?:3|5|7|8|9)(?:[ .-]?\d){8}(?!\d)",
    "URL": r"(?iU)https?://[^\s<>]+",
    "DATE": r"(?U)(?<!\d)(?:0?[1-9]|[12]\d|3[01])[/.-](?:0?[1-9]|1[0-2])[/.-](?:19|20)\d{2}(?!\d)",
    "TIME": r"(?iU)(?<!\d)(?:(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?|(?:0?[1-9]|1[0-2]):[0-5]\d\s?(?:AM|PM))(?!\d)",
    "IP": r"(?U)(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])",
    "ACCOUNT_ID": r"(?iU)\b(?:ACC|USR|EMP|INC|BH)-[A-Z0-9]{5,}\b",
}
#: Tokens of another locale or of a placeholder.
MIXED_LOCALE = r"(?iU)JaneHuyện|JohnQuận|SmithPhường|\b(?:County|Street|Avenue|undefined|null|N/A|xxx)\b"
#: Cities that an address ends with, labels of digits alone, shapes of bare values.
CITIES = ("TP. Hồ Chí Minh", "Đà Nẵng", "Hà Nội")
DIGIT_LABELS = ("CARD_NUMBER", "NATIONAL_ID", "BANK_ACCOUNT", "TIN", "ZIP_CODE", "CVV", "PIN")
SHAPES = {
    "ZIP_CODE": r"^[0-9]{5,6}$",
    "CARD_NUMBER": r"^[0-9]{13,19}$",
    "CVV": r"^[0-9]{3,4}$",
    "PIN": r"^[0-9]{3,4}$",
    "IBAN": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$",
    "SWIFT": r"^[A-Z]{6}[A-Z0-9]{2}([A-Z0-9]{3})?$",
    "WALLET": r"^0x[0-9a-fA-F]{40}$",
}
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
H16 = "[0-9A-Fa-f]{1,4}"
IPV6 = "^((" + "|".join([f"({H16}:){{7}}{H16}", *(f"({H16}:){{1,{i}}}(:{H16}){{1,{7 - i}}}" for i in range(1, 7)), f":((:{H16}){{1,7}}|:)", f"({H16}:){{1,7}}:"]) + "))$"


#: Characters of which a match holds one at least, by detector: a look for them is cheaper than the pattern.
NEEDED = {"EMAIL": "@", "URL": "://", "TIME": ":", "IP": ".", "ACCOUNT_ID": "-"}


def all_matches(text: Column, label: str) -> Column:
    return F.regexp_extract_all(text, F.lit(DETECTORS[label]), F.lit(0))


def first_matches(text: Column) -> Column:
    """array<struct<label, value>>: the first match of each detector that has one. Each pattern runs once, and only over texts with
    the characters that it needs; text is best a column of its own, as each detector reads it."""

    def first(label: str, pattern: str) -> Column:
        value = F.regexp_extract(text, pattern, 0)  # no match is an empty one
        value = F.when(text.contains(NEEDED[label]), value).otherwise("") if label in NEEDED else value
        return F.struct(F.lit(label).alias("label"), value.alias("value"))

    return F.filter(F.array(*(first(label, p) for label, p in DETECTORS.items())), lambda m: m["value"] != "")


def _date(value: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    year, month, day = (F.regexp_extract(value, pattern, i).try_cast("int") for i in order)
    return value.rlike(pattern) & F.coalesce((F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0))).isNotNull(), F.lit(False))


def _shaped(value: Column) -> dict[str, Column]:
    """For each label with a format of its own, whether the value has it."""
    full = lambda p: value.rlike(p)
    date = _date(value, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", (3, 2, 1)) | _date(value, r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})$", (3, 2, 1)) | _date(value, r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", (1, 2, 3))
    return {
        "EMAIL": full(_whole("EMAIL")),
        "PHONE": full(_whole("PHONE")),
        "DATE": date,
        "BIRTHDATE": date,
        "TIME": full(r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9](:([0-5]?[0-9]|6[01]))?$") | full(r"(?i)^(0?[1-9]|1[0-2]):[0-5]?[0-9]\s+(AM|PM)$"),
        "URL": full(r"(?i)^https?://[^/?#]+"),
        "IP": full(rf"^({OCTET}\.){{3}}{OCTET}$") | full(IPV6),
        "ADDRESS": value.contains(" đường ") & value.contains("phường") & F.greatest(*(value.endswith(c) for c in CITIES)),
    }


def _whole(label: str) -> str:
    """A detector's pattern for a value as a whole, without what may stand around it."""
    return "(?U)^" + re.sub(r"\(\?<?!.*?\)", "", DETECTORS[label].removeprefix("(?U)")) + "$"


def valid_format(label: Column, value: Column) -> Column:
    """Whether a value has its label's format; labels without one need a value that is not blank."""
    out = F.when(label.isin(*DIGIT_LABELS), value.rlike(r"^\p{Nd}+$")).otherwise(F.length(F.regexp_replace(value, r"^\s+|\s+$", "")) > 0)
    for name, fits in _shaped(value).items():
        out = F.when(label == name, fits).otherwise(out)
    return out


def structured_labels(value: Column) -> Column:
    """Sorted labels whose format the bare value has."""
    found = [F.when(fits, F.lit(name)) for name, fits in _shaped(value).items()] + [F.when(value.rlike(p), F.lit(name)) for name, p in SHAPES.items()]
    return F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()))


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload + digit pass the Luhn test."""
    each = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return ((10 - F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")
