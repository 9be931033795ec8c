"""Text-to-typed Column functions.

Each takes a text column and returns a typed one. An empty string is NULL. What cannot be typed
fails the job by default (``on_error="fail"``) or becomes NULL (``on_error="null"``); the checks
are spelled out, so they hold whether or not the session runs in ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# An eight-digit date; \z and not $, which also matches before a last line break.
EIGHT_DIGITS = r"^[0-9]{8}\z"
EMPTY_DATE = "00000000"

FAIL, NULL = "fail", "null"


def text(c: Column) -> Column:
    """Empty string to NULL."""
    return F.nullif(c, F.lit(""))


def char(c: Column, n: int) -> Column:
    """At most ``n`` characters, without the trailing blanks that char(n) ignores."""
    return F.rtrim(F.substring(text(c), 1, n))


def integer(c: Column, on_error: str = FAIL) -> Column:
    return _or_fail(text(c), text(c).try_cast("int"), "int", on_error)


def decimal(c: Column, scale: int = 2, on_error: str = FAIL) -> Column:
    """Decimal comma to numeric(18, scale), rounded half up."""
    kind = f"decimal(18,{scale})"
    raw = text(F.replace(c, F.lit(","), F.lit(".")))
    return _or_fail(raw, raw.try_cast(kind), kind, on_error)


def date(c: Column, on_error: str = FAIL) -> Column:
    """``yyyyMMdd`` to date. Anything but eight digits, and 00000000, is NULL; eight digits that
    name no day of a year from 1 on are an error."""
    raw = F.when(c.rlike(EIGHT_DIGITS) & (c != EMPTY_DATE), c)
    # As ISO text it is cast directly, which is faster than a date format.
    iso = F.concat(raw.substr(1, 4), F.lit("-"), raw.substr(5, 2), F.lit("-"), raw.substr(7, 2))
    day = F.when(~raw.startswith("0000"), iso.try_cast("date"))
    return _or_fail(raw, day, "date", on_error)


def full_key(*parts: Column, width: int = 14) -> Column:
    """Concatenated key, NULL if any part is."""
    return F.rtrim(F.substring(F.concat(*parts), 1, width))


def padded_code(code: Column, width: int) -> Column:
    """Numeric code as text with its leading zeros back."""
    digits = code.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def typed(c: Column, kind: str, on_error: str = FAIL) -> Column:
    """Column function for a type name as used in the table definitions."""
    name, args = _parse(kind)
    if name == "text":
        return text(c)
    if name == "char":
        return char(c, args[0])
    if name == "int":
        return integer(c, on_error)
    if name == "numeric":
        return decimal(c, args[1], on_error)
    if name == "date":
        return date(c, on_error)
    raise ValueError(f"unknown type {kind!r}")


def can_fail(kind: str) -> bool:
    return _parse(kind)[0] in ("int", "numeric", "date")


def is_rejected(c: Column, kind: str) -> Column:
    """True where a value is present but cannot be typed."""
    present = text(c).isNotNull()
    if _parse(kind)[0] == "date":
        present = c.rlike(EIGHT_DIGITS) & (c != EMPTY_DATE)
    return F.coalesce(present, F.lit(False)) & typed(c, kind, NULL).isNull()


def _parse(kind: str) -> tuple[str, list[int]]:
    name, args = re.fullmatch(r"(\w+)(?:\(([\d,]+)\))?", kind).groups()
    return name, [int(arg) for arg in args.split(",")] if args else []


def _or_fail(raw: Column, value: Column, kind: str, on_error: str) -> Column:
    if on_error == NULL:
        return value
    message = F.concat(F.lit(f"not a valid {kind}: "), raw)
    return F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(message).cast(kind)))
