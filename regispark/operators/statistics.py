"""Statistics of written tables, measured once and merged, that plans read instead of running jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.operators.sizing import row_bytes

COLUMNS = "column string, rows bigint, bytes bigint, nulls bigint, most bigint, sketch binary"


@dataclass(frozen=True)
class Statistics:
    """Rows, their in-memory bytes, and for some columns the most rows that one value holds (NULL aside;
    negative where it is a bound only), about how many values there are, and how many NULLs."""

    rows: int
    bytes: int
    most: dict[str, int] = field(default_factory=dict)
    distinct: dict[str, int] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)

    def unique(self, column: str) -> bool | None:
        """Whether no value but NULL repeats; None where that was not measured, or not of all rows together."""
        most = self.most.get(column)
        if most is None or most < 0:
            return None
        return most <= 1

    def hot(self, column: str, rows: int) -> bool | None:
        """Whether a value may hold ``rows`` rows or more; None if unknown."""
        most = self.most.get(column)
        return None if most is None else abs(most) >= rows


def measure(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for the table (``column`` NULL) and one per key, with a mergeable sketch of its values.

    ``df`` is read twice at most: once for sizes and sketches, once for the keys alone. Sorted files
    make the count per key one of nearly as many rows as there are keys.
    """
    sketches = [F.hll_sketch_agg(F.col(k).cast("string")).alias(f"sketch_{i}") for i, k in enumerate(keys)]
    nulls = [F.count_if(F.col(k).isNull()).alias(f"nulls_{i}") for i, k in enumerate(keys)]
    whole = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes"), *nulls, *sketches
    )
    none = F.lit(None)
    rows = [
        F.struct(
            none.cast("string").alias("column"), "rows", "bytes", none.cast("bigint").alias("nulls"),
            none.cast("binary").alias("sketch"),
        ),
        *[
            F.struct(
                F.lit(k).alias("column"), "rows", none.cast("bigint").alias("bytes"), F.col(f"nulls_{i}").alias("nulls"),
                F.col(f"sketch_{i}").alias("sketch"),
            )
            for i, k in enumerate(keys)
        ],
    ]
    told = whole.select(F.inline(F.array(*rows)))
    most = None
    for k in keys:
        held = df.where(F.col(k).isNotNull()).groupBy(k).agg(F.count("*").alias("n"))
        one = held.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most")).select(F.lit(k).alias("_column"), "most")
        most = one if most is None else most.unionByName(one)
    if most is None:
        return told.withColumn("most", none.cast("bigint")).select(*_names())
    joined = told.join(most, F.col("column") == F.col("_column"), "left")
    return joined.select(*_names())


def merged(parts: DataFrame) -> DataFrame:
    """Statistics of several tables' rows together, from ``measure`` of each.

    Sizes add up and sketches unite. A value of one table may be in another: the most rows of one is
    at most the sum, given as a negative number where that is a bound only.
    """
    several = F.count("*") > 1
    most = F.when(several, -F.sum(F.abs("most"))).otherwise(F.max("most"))
    most = F.when(F.sum(F.abs("most")) == 0, F.lit(0)).otherwise(most)
    return parts.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.sum("nulls").alias("nulls"), most.alias("most"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
    ).select(*_names())


def told(parts: DataFrame) -> Statistics:
    """Statistics of one table as numbers: one row per key column and one for the table."""
    rows = parts.withColumn("distinct", F.when(F.col("sketch").isNotNull(), F.hll_sketch_estimate("sketch"))).drop("sketch")
    rows = rows.collect()
    whole = next(r for r in rows if r["column"] is None)
    keys = [r for r in rows if r["column"] is not None]
    by_key = [{r["column"]: r[what] for r in keys} for what in ("most", "distinct", "nulls")]
    return Statistics(whole["rows"], whole["bytes"], *by_key)


def _names() -> list[str]:
    return [part.split()[0] for part in COLUMNS.split(", ")]
