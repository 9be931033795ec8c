"""Windows-1252 bytes to text, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8859-1 and Windows-1252 differ only in 0x80-0x9F; bytes the code page leaves undefined
# become U+FFFD.
_BYTES = range(0x80, 0xA0)
LATIN1_CONTROLS = "".join(chr(b) for b in _BYTES)
CP1252_CHARS = "".join(bytes([b]).decode("cp1252", errors="replace") for b in _BYTES)


def latin1(raw: Column) -> Column:
    """Binary to text, one character per byte."""
    return F.decode(raw.cast("binary"), "ISO-8859-1")


def cp1252(raw: Column) -> Column:
    """Binary to text, undefined bytes replaced."""
    return controls_to_cp1252(latin1(raw))


def controls_to_cp1252(decoded: Column) -> Column:
    """Maps what an ISO-8859-1 reader made of bytes 0x80-0x9F.

    Mapping goes character by character, so lines without such a byte, nearly all, skip it. In
    UTF-8 they start with C2, as do the signs up to U+00BF: two searches, the cheap one first.
    """
    mapped = F.translate(decoded, LATIN1_CONTROLS, CP1252_CHARS)
    possible = F.contains(decoded.cast("binary"), F.lit(b"\xc2"))
    return F.when(possible & decoded.rlike("[\x80-\x9f]"), mapped).otherwise(decoded)


def strip_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit(""))
