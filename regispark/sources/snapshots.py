"""Snapshot tables: one partition per publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def at_snapshot(df: DataFrame, value: object, column: str = "snapshot") -> DataFrame:
    """Rows of one publication; prunes partitions when the table is partitioned by ``column``."""
    return df.where(F.col(column) == F.lit(value))
