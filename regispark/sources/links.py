"""Links of index pages, as a parser of the page sees them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a page is cut into: comments and the raw text of scripts and styles, which hold no tags, and tags.
# Nothing in them is tried twice, so a page of any size takes one pass.
TOKENS = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style|textarea|title)\b.*?(?:</\1\s*+>|\z)"
    r"""|<[a-z][^\s/>"']*+[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
)
NO_TAG = r"(?i)^<(?:!--|(?:script|style|textarea|title)\b)"
# An attribute with a value: quoted in either way or not at all.
ATTRIBUTE = r"""([^\s"'<>/=]+)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
PIECES = r"&(?:#[0-9]{1,7};|#[xX][0-9A-Fa-f]{1,6};|[A-Za-z]{2,8};)|[^&]+|&"
# Named references that stand in links.
REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def extract_links(
    pages: DataFrame, html: str = "html", base: str = "url", suffix: str | None = None
) -> DataFrame:
    """Pages exploded to one row per link: ``link`` with its character references read, and ``target`` made absolute.

    Links are ``href`` attributes of tags; what looks like one in a comment, a script, a style or in another
    attribute is none. ``suffix`` keeps links that end in it, whatever their case (``".zip"`` for
    an archive index).
    """
    kept = [c for c in pages.columns if c != html]
    tokens = F.regexp_extract_all(F.col(html), F.lit(TOKENS), 0)
    tags = F.filter(tokens, lambda t: F.lower(t).contains("href") & ~t.rlike(NO_TAG))
    found = pages.select(*kept, F.explode(F.transform(tags, _href)).alias("link"))
    found = found.withColumn("link", _read(F.regexp_replace(F.trim("link"), r"[\t\r\n]", "")))
    found = found.where(F.col("link") != "")
    if suffix:
        found = found.where(F.lower("link").endswith(suffix.lower()))
    return found.withColumn("target", join_url(F.col(base), F.col("link")))


def _href(tag: Column) -> Column:
    """Value of the first ``href`` of a tag; NULL without one."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1).alias("name"),
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 2).alias("value"),
    )
    value = F.get(F.filter(pairs, lambda p: F.lower(p["name"]) == "href"), F.lit(0))["value"]
    return F.regexp_replace(value, r"""^["']|["']$""", "")


def _read(link: Column) -> Column:
    """Text with its character references replaced, each once."""

    def piece(p: Column) -> Column:
        name = F.substring(p, 2, 9)
        code = F.when(
            p.rlike("^&#[xX][0-9A-Fa-f]+;$"), F.conv(F.regexp_extract(p, "([0-9A-Fa-f]+);$", 1), 16, 10).cast("bigint")
        ).when(p.rlike("^&#[0-9]+;$"), F.regexp_extract(p, "([0-9]+);$", 1).cast("bigint"))
        sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        told = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        named = p
        for reference, character in REFERENCES.items():
            named = F.when(name == f"{reference};", F.lit(character)).otherwise(named)
        return F.when(p.startswith("&#") & p.endswith(";"), told).when(p.startswith("&"), named).otherwise(p)

    pieces = F.transform(F.regexp_extract_all(link, F.lit(PIECES), 0), piece)
    return F.when(link.contains("&"), F.array_join(pieces, "")).otherwise(link)


def join_url(base: Column, link: Column) -> Column:
    """URL join: absolute and scheme-relative links as they are, the others against the page's address, with
    their ``.`` and ``..`` segments resolved."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_replace(F.substring(page, F.length(origin) + 1, F.length(page)), r"[^/]*$", "")
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.substring(link, F.length(path) + 1, F.length(link))
    whole = F.when(link.startswith("/"), path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    return (
        F.when(link.rlike(ABSOLUTE), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]+:)", 1), link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, without_dots(whole), rest))
    )


def without_dots(path: Column) -> Column:
    """A path from the root with its ``.`` and ``..`` segments resolved: a fold with a stack of segments."""
    segments = F.split(path, "/")

    def step(stack: Column, segment: Column) -> Column:
        back = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        return F.when(segment == "..", back).when(segment == ".", stack).otherwise(F.concat(stack, F.array(segment)))

    steps = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    # A last segment of dots names a folder.
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)
