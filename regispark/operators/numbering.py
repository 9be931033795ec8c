"""Row numbers and row ranges that hold when one key has a large part of all rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from regispark.operators.sizing import HOT_ROWS, broadcast_if_small, heavy_keys, split_by_keys, with_place
from regispark.session import materialize

ROW = "_row"
# monotonically_increasing_id: partition number above bit 33, place in the partition below.
PART_BITS = 33

#: Parts a range of rows is divided into at a time, and keys looked at for that.
DIVISIONS = 64
SAMPLED = 4_096
#: Rows of a sorted part of hot keys at least, once there are ``FEW_PARTS``: each part is a task, and every
#: task that sorts sends a piece to each.
PART_ROWS = 250_000
FEW_PARTS = 256
#: Rows that are sorted as they are, without narrowing the range further.
SMALL_RANGE = 1_000_000


def row_numbers(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    number: str = "row_number",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number()`` per key in a given order.

    Keys too large for one task, however many there are, are range-sorted by ``order`` over many,
    and their numbers put together from the size of each sorted part.
    """
    hot = heavy_keys(df, key, min_rows=hot_rows)
    in_order = Window.partitionBy(key).orderBy(*order)
    counted = F.row_number().over(in_order).cast("bigint")
    total = hot.agg(F.sum("n")).first()[0]
    if not total:
        return df.withColumn(number, counted)
    others, alike = split_by_keys(df, hot, key)
    cold = others.withColumn(number, counted)
    parts = min(math.ceil(2 * total / hot_rows), max(FEW_PARTS, math.ceil(total / PART_ROWS)))
    runs = _sorted(with_place(alike, "_place"), [key, *order], parts=parts)
    ((starts, _),) = broadcast_if_small(_part_starts(runs, key))
    spread = (
        runs.withColumn("_part", _part())
        .join(starts, _same_run(key), "inner")
        .withColumn(number, F.col("_before") + F.col(ROW) - F.col("_first") + 1)
    )
    return cold.unionByName(spread.select(*df.columns, number))


def sorted_runs(df: DataFrame, by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows in global order, written once, with an ascending ``_row``."""
    if not heavy_keys(df, *by, min_rows=hot_rows).isEmpty():
        df = with_place(df, "_place")
    return _sorted(df, by)


def row_range(
    df: DataFrame, by: Sequence[str], skip: int, take: int, *, small: int = SMALL_RANGE
) -> DataFrame:
    """Rows ``skip`` to ``skip + take`` in the order of the columns ``by``, of any type.

    Whole keys are sampled, and rows counted below some of them, which divide the range that the wanted
    rows fall in; again within the part they fall in, until it is ``small`` or cannot be divided.
    These passes read ``by`` alone. Only the rows of the last part are read whole, sorted and written.
    To go through a whole table chunk by chunk, sort it once: ``sorted_runs``, ``Chunks``.
    """
    low = high = None
    before, inside = 0, df.count()
    while inside > max(small, take):
        keys = _between(df, by, low, high).select(*by)
        new_low, new_high, above = low, high, inside
        below = 0
        for value, count in _counts_below(keys, by, inside):
            if before + count <= skip:
                new_low, below = value, count
            elif before + count >= skip + take:
                new_high, above = value, count
                break
        if above - below >= inside:
            break
        low, high, before, inside = new_low, new_high, before + below, above - below
    return Chunks(sorted_runs(_between(df, by, low, high), by)).rows(skip - before, take)


class Chunks:
    """Chunks of ``sorted_runs`` by row number; the sizes of its parts, one row each, are read once."""

    def __init__(self, runs: DataFrame):
        self.runs = runs
        sizes = runs.groupBy(_part().alias("part")).agg(F.count("*").alias("n"), F.min(ROW).alias("first"))
        self.parts = sizes.orderBy("part").collect()

    def rows(self, skip: int, take: int) -> DataFrame:
        """Rows ``skip`` to ``skip + take``; bounds on ``_row`` are pushed down to the files."""
        begin = end = None
        seen = 0
        for part in self.parts:
            if begin is None and skip < seen + part["n"]:
                begin = part["first"] + skip - seen
            if skip + take <= seen + part["n"]:
                end = part["first"] + skip + take - seen
                break
            seen += part["n"]
        if begin is None or take <= 0:
            return self.runs.where(F.lit(False)).drop(ROW)
        chunk = self.runs.where(F.col(ROW) >= begin)
        if end is not None:
            chunk = chunk.where(F.col(ROW) < end)
        return chunk.drop(ROW)


def rows_between(runs: DataFrame, skip: int, take: int) -> DataFrame:
    """One chunk of ``sorted_runs``; as many tasks read it as it has sorted parts."""
    return Chunks(runs).rows(skip, take)


def _literal(df: DataFrame, by: Sequence[str], value: Row) -> Column:
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(by, value)])


def _below(df: DataFrame, by: Sequence[str], value: Row) -> Column:
    """Whether a row's key sorts before ``value``; NULLs sort first, also within keys."""
    return F.struct(*by) < _literal(df, by, value)


def _between(df: DataFrame, by: Sequence[str], low: Row | None, high: Row | None) -> DataFrame:
    """Rows with keys from ``low`` on, before ``high``. The bounds on the leading column reach the files."""
    lead = F.col(by[0])
    kind = df.schema[by[0]].dataType
    if low is not None:
        if low[0] is not None and low[0] == low[0]:
            df = df.where(lead >= F.lit(low[0]).cast(kind))
        df = df.where(~_below(df, by, low))
    if high is not None:
        if high[0] is None:
            df = df.where(lead.isNull())
        elif high[0] == high[0]:
            df = df.where(lead.isNull() | (lead <= F.lit(high[0]).cast(kind)))
        df = df.where(_below(df, by, high))
    return df


def _counts_below(keys: DataFrame, by: Sequence[str], rows: int) -> list[tuple[Row, int]]:
    """Some keys, ascending, with the exact number of rows that sort before each."""
    sample = keys.sample(min(1.0, SAMPLED / rows), 17) if rows > SAMPLED else keys
    held = sample.orderBy(F.xxhash64(*by)).limit(2 * SAMPLED).distinct().orderBy(F.struct(*by)).collect()
    chosen = held[:: max(1, len(held) // DIVISIONS)]
    if not chosen:
        return []
    below = keys.agg(*[F.count_if(_below(keys, by, value)).alias(f"_{k}") for k, value in enumerate(chosen)]).first()
    return list(zip(chosen, below))


def _sorted(df: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    # The place, if there is one, is the last sort column: it lets copies of a row spread.
    order = [*by, *(c for c in df.columns if c == "_place")]
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if parts else df.sort(*order)
    return materialize(ordered.drop("_place").withColumn(ROW, F.monotonically_increasing_id()), "runs")


def _part() -> Column:
    return F.shiftright(F.col(ROW), PART_BITS)


def _part_starts(runs: DataFrame, key: str) -> DataFrame:
    """First row and number of earlier rows for each hot key and part."""
    sizes = runs.groupBy(F.col(key).alias("_key"), _part().alias("_in")).agg(
        F.count("*").alias("_n"), F.min(ROW).alias("_first")
    )
    earlier = Window.partitionBy("_key").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")


def _same_run(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in"))
