"""Lenient parsing of text into readings and timestamps, as plain Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.schema import EARLIEST, LATEST, MISSING_TOKENS

# Decimal text only. It keeps out what the JVM's double parser also takes: 1d, 1f, 0x1p3, NaN.
# No part gives back what it has taken, so a text is read once however long it is.
DECIMAL_TEXT = r"^\s*+[+-]?(\d++(\.\d*+)?|\.\d++)([eE][+-]?\d++)?\s*+$"

_FORMAT_FIELDS = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}


def missing_to_null(text: Column) -> Column:
    """Turn the recognised spellings of a missing value into NULL. The match is exact."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def number_or_null(value: Column) -> Column:
    """Parse decimal text to BIGINT, cut toward zero; NULL where it is not a number in range.

    Whole numbers parse directly and stay exact over the full 64 bits, other numbers go
    through a double. The pattern comes first because a failing ``try_cast`` to BIGINT costs
    an exception, some thirty times the match.
    """
    text = value.cast("string")
    has_fraction = text.contains(".") | text.contains("e") | text.contains("E")
    # 2^63 as a double casts to the largest BIGINT, as if it were in range; adding 1 tells.
    truncated = F.try_add(text.try_cast("double").try_cast("bigint"), F.lit(1)) - 1
    number = F.when(has_fraction, truncated).otherwise(text.try_cast("bigint"))
    return F.when(text.rlike(DECIMAL_TEXT), number)


def reading(value: Column) -> Column:
    """A reading as BIGINT: unparseable, out-of-range and missing values count as 0."""
    return F.coalesce(number_or_null(value), F.lit(0).cast("bigint"))


def is_rejected(value: Column) -> Column:
    """True for a value that is present but not a usable number; missing tokens are not present."""
    present = missing_to_null(value.cast("string")).isNotNull()
    return present & number_or_null(value).isNull()


def wall_clock(value: Column, formats: Iterable[str] = ()) -> Column:
    """Parse text to TIMESTAMP_NTZ; NULL where it is not a timestamp in the supported range.

    ISO text is always understood; a zone offset in it is ignored, the wall clock counts.
    ``formats`` adds patterns made of yyyy, MM, dd, HH, mm and ss, tried in order. They are
    rewritten to ISO text first, so the result never depends on the session time zone.
    """
    text = value.cast("string")
    candidates = [text.try_cast("timestamp_ntz")]
    candidates += [_as_iso_text(text, f).try_cast("timestamp_ntz") for f in formats]
    parsed = F.coalesce(*candidates)
    # Limits as text: a Python datetime would become a zoned literal.
    first, last = (F.lit(limit).cast("timestamp_ntz") for limit in (EARLIEST, LATEST))
    return F.when(parsed.between(first, last), parsed)


def text_types(value: Column) -> dict[str, Column]:
    """For each type a text may stand for, whether it does; every type comes before those that contain it."""
    day = value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    stamp = value.rlike(r"^\d{4}-\d{2}-\d{2}")
    return {
        "bigint": F.when(value.rlike(r"^\s*+[+-]?\d++\s*+$"), value.try_cast("bigint")).isNotNull(),
        "double": value.rlike(DECIMAL_TEXT),
        "boolean": value.isin("True", "False", "TRUE", "FALSE", "true", "false"),
        "date": F.when(day, value.try_cast("date")).isNotNull(),
        "timestamp": F.when(stamp, value.try_cast("timestamp_ntz")).isNotNull(),
    }


def _as_iso_text(text: Column, fmt: str) -> Column:
    pieces = re.split("(" + "|".join(_FORMAT_FIELDS) + ")", fmt)
    fields = [p for p in pieces if p in _FORMAT_FIELDS]
    if len(set(fields)) != len(fields) or not {"yyyy", "MM", "dd"} <= set(fields):
        raise ValueError(f"format {fmt!r} needs yyyy, MM and dd, and each field at most once")
    pattern = "".join(
        rf"(\d{{{_FORMAT_FIELDS[p]}}})" if p in _FORMAT_FIELDS else re.escape(p) for p in pieces
    )
    pattern = rf"^\s*{pattern}\s*$"
    group = {f: f"${fields.index(f) + 1}" for f in fields}
    clock = ":".join(group.get(f, "00") for f in ("HH", "mm", "ss"))
    iso = f"{group['yyyy']}-{group['MM']}-{group['dd']} {clock}"
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso))
