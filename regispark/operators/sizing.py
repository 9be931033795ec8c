"""Checks made before a plan is chosen: is a side small, which keys are hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regispark.session import materialize

MIB = 1024 * 1024
BROADCAST_LIMIT = 64 * MIB
ROW_OVERHEAD = 64
FIXED_WIDTH = 8

HOT_ROWS = 1_000_000
LEAST_BUCKETS = 4_096


def measured_bytes(*sides: DataFrame) -> list[int]:
    """In-memory size of each side, counted over all its rows in one job."""
    sized = [
        df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes"))
        .withColumn("side", F.lit(i))
        for i, df in enumerate(sides)
    ]
    together = sized[0]
    for one in sized[1:]:
        together = together.unionByName(one)
    found = {row["side"]: row["bytes"] for row in together.collect()}  # one row per side
    return [found[i] for i in range(len(sides))]


def broadcast_if_small(
    *sides: DataFrame, limit: int = BROADCAST_LIMIT, known: Sequence[int | None] = ()
) -> list[tuple[DataFrame, bool]]:
    """Each side with a broadcast hint where its measured size is within ``limit``.

    The others come back with a shuffled-join hint, which AQE can split on skewed keys. ``known`` are
    bounds on the sizes from statistics, if there are any: a side within ``limit`` by its bound is not
    measured.
    """
    bounds = [*known, *[None] * (len(sides) - len(known))]
    open_ = [i for i, bound in enumerate(bounds) if bound is None or bound > limit]
    sizes = dict(enumerate(bounds))
    if open_:
        sizes |= zip(open_, measured_bytes(*[sides[i] for i in open_]))
    return [
        (F.broadcast(df), True) if sizes[i] <= limit else (df.hint("merge"), False) for i, df in enumerate(sides)
    ]


def heavy_keys(df: DataFrame, *keys: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that at least ``min_rows`` rows hold, with their number of rows ``n``; exact, NULL included.

    Rows are first counted by a hash of the key, in so many buckets that an even one holds an eighth of
    ``min_rows``: combined before the shuffle, that moves bucket numbers only. A key in a bucket
    below ``min_rows`` cannot be heavy, so only rows of the others, few or none, are counted by
    key. There are at most rows / ``min_rows`` such keys; they come as a written table.
    """
    named = df.select(*keys)
    rows = named.count()
    buckets = max(LEAST_BUCKETS, 8 * rows // min_rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    full = []
    if rows >= min_rows:
        counted = named.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
        # At most rows / min_rows numbers.
        full = [(r["bucket"],) for r in counted.where(F.col("n") >= min_rows).collect()]
    spark = df.sparkSession
    if not full:
        fields = [named.schema[c] for c in keys]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("n", T.LongType())]))
    ((side, _),) = broadcast_if_small(spark.createDataFrame(full, "_bucket bigint"))
    suspects = named.withColumn("_bucket", bucket).join(side, "_bucket", "left_semi")
    found = suspects.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)
    return materialize(found, "heavy")


def split_by_keys(df: DataFrame, keys: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not in ``keys``, and those whose key is; NULL equals NULL."""
    ((side, _),) = broadcast_if_small(keys.select(*[F.col(c).alias(f"_{c}") for c in on]))
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that more than one row holds, NULL included; only that column is read, and equal
    values are combined before the shuffle."""
    counted = df.groupBy(column).agg(F.count("*").alias("_n"))
    return counted.where(F.col("_n") > 1).select(column)


def any_repeated(*sides: DataFrame) -> bool:
    """Whether any one-column side holds a non-NULL value twice; one job for all of them."""
    parts = [
        repeated_values(side.dropna(), side.columns[0]).select(F.lit(i).alias("side"))
        for i, side in enumerate(sides)
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return not together.isEmpty()


def with_place(df: DataFrame, name: str) -> DataFrame:
    """Numbers the rows of each partition, to spread rows that are alike in all their keys.

    The local sort on every column makes the numbers repeatable when a task is run again, also
    behind a shuffle, where rows arrive in any order.
    """
    in_order = df.sortWithinPartitions(*df.columns)
    return in_order.withColumn(name, F.monotonically_increasing_id())


def row_bytes(df: DataFrame) -> Column:
    total = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + FIXED_WIDTH + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.AtomicType,)):
            total = total + FIXED_WIDTH
        else:
            as_text = F.to_json(F.struct(field.name))
            total = total + FIXED_WIDTH + F.coalesce(F.octet_length(as_text), F.lit(0))
    return total.cast("bigint")
