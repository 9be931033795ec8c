"""Numbered rows to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_slots(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], slot: str, slots: int
) -> DataFrame:
    """One row per key group with ``<value>_<i>`` for each slot 1 to ``slots``; NULL keys group
    together, rows beyond the last slot only keep their group.

    A conditional max per slot: one aggregation, combined before the shuffle, and no job to find
    the slot values first.
    """

    def at(value: str, i: int) -> Column:
        return F.max(F.when(F.col(slot) == i, F.col(value))).alias(f"{value}_{i}")

    columns = [at(value, i) for i in range(1, slots + 1) for value in values]
    return rows.groupBy(*keys).agg(*columns)
