"""Comma lists of codes: split, number, unnest."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_codes(c: Column, separator: str = ",") -> Column:
    """NULL stays NULL, '' is one empty code, empty items and blanks are kept."""
    return F.split(c, re.escape(separator), -1)


def slot_count(codes: Column) -> Column:
    """Rows an outer unnest makes of a list: a NULL list still makes one."""
    return F.when(codes.isNull(), F.lit(1)).otherwise(F.size(codes))


def unnest_codes(df: DataFrame, codes: str, code: str = "code", slot: str = "slot") -> DataFrame:
    """One row per list item with its 1-based place; a NULL list keeps its row with a NULL code.

    Narrow: rows stay in their partition.
    """
    others = [F.col(c) for c in df.columns if c != codes]
    exploded = df.select(*others, F.posexplode_outer(codes).alias("_pos", code))
    number = (F.coalesce(F.col("_pos"), F.lit(0)) + 1).cast("bigint").alias(slot)
    return exploded.select(*others, F.col(code), number)
