"""Joins of the registry model: dictionary lookups, company to establishment, existence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.operators.sizing import (
    BROADCAST_LIMIT,
    HOT_ROWS,
    broadcast_if_small,
    heavy_keys,
    split_by_keys,
    with_place,
)
from regispark.session import materialize


def lookup(
    df: DataFrame,
    dictionary: DataFrame,
    on: str,
    description: str,
    *,
    code: str = "codigo",
    value: str = "descricao",
) -> DataFrame:
    """Left join to a code dictionary, adding ``description``.

    The dictionary comes already hinted (see ``lookups``); unknown codes get NULL, a code listed
    twice gives two rows.
    """
    side = dictionary.select(F.col(code).alias("_code"), F.col(value).alias(description))
    return df.join(side, F.col(on) == F.col("_code"), "left").drop("_code")


def lookups(
    df: DataFrame,
    steps: Sequence[tuple[DataFrame, str, str]],
    *,
    code: str = "codigo",
    value: str = "descricao",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Chain of dictionary lookups ``(dictionary, column, description)``.

    All dictionaries are sized in one job; those within the limit are broadcast, so the chain
    needs no shuffle of ``df``. Larger ones are cut to the codes that ``df`` has first.
    """
    sides = [dictionary.select(code, value) for dictionary, _, _ in steps]
    rows = df
    for (side, small), (dictionary, on, description) in zip(broadcast_if_small(*sides, limit=limit), steps):
        if not small and limit > 0:
            side, _ = used_entries(dictionary.select(code, value), code, rows.select(on), limit)
        df = lookup(df, side, on, description, code=code, value=value)
    return df


def used_entries(
    dictionary: DataFrame, code: str, used: DataFrame, limit: int = BROADCAST_LIMIT
) -> tuple[DataFrame, bool]:
    """Entries of a large dictionary with one of the codes in the one column of ``used``, written; with the
    hint for a join that ``broadcast_if_small`` gives, and whether they are few.

    Rows have mostly few of the codes there could be, and equal ones are combined before the shuffle.
    """
    ((keys, _),) = broadcast_if_small(key_set(used, used.columns[0]).toDF("_used"), limit=limit)
    kept = materialize(dictionary.join(keys, F.col(code) == F.col("_used"), "left_semi"), "entries")
    ((side, small),) = broadcast_if_small(kept, limit=limit)
    return side, small


def company_establishment(
    companies: DataFrame,
    establishments: DataFrame,
    on: str = "cnpj_basico",
    *,
    keep_unmatched: bool = True,
    limit: int = BROADCAST_LIMIT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Companies with their establishments; without ``keep_unmatched`` only those that have one.

    An inner join broadcasts the companies if they are few and otherwise leaves skewed keys to
    AQE, which can split the establishments of one company. The outer join cannot be split that
    way (its establishments are the null-supplying side). Companies with at least ``hot_rows``
    establishments are found first; they cannot be unmatched, so they take an inner join: few of
    them are broadcast, and their establishments stay where they are. More are copied, each as often as
    its establishments fill ``hot_rows``, over which these are spread by their place.
    """
    if not keep_unmatched:
        ((companies, _),) = broadcast_if_small(companies, limit=limit)
        return companies.join(establishments, on, "inner")

    hot = heavy_keys(establishments.where(F.col(on).isNotNull()), on, min_rows=hot_rows)
    if hot.isEmpty():
        return companies.join(establishments, on, "left")
    other_companies, hot_companies = split_by_keys(companies, hot, on)
    other_rows, hot_establishments = split_by_keys(establishments, hot, on)
    rest = other_companies.join(other_rows, on, "left")
    ((few, small),) = broadcast_if_small(hot_companies, limit=limit)
    if small:
        return rest.unionByName(few.join(hot_establishments, on, "inner"))
    return rest.unionByName(_in_pieces(hot_companies, hot_establishments, hot, on, hot_rows))


def _in_pieces(one: DataFrame, many: DataFrame, hot: DataFrame, on: str, hot_rows: int) -> DataFrame:
    """Inner join where no task gets more than about ``hot_rows`` rows of a key of ``hot`` (key, ``n``)."""
    ((pieces, _),) = broadcast_if_small(hot.select(on, F.ceil(F.col("n") / hot_rows).alias("_pieces")))
    copies = one.join(pieces, on).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
    placed = with_place(many, "_place").join(pieces, on)
    # A hash of the place, as the places of a task are in a row.
    spread = placed.withColumn("_piece", F.pmod(F.xxhash64("_place"), F.col("_pieces"))).drop("_place", "_pieces")
    return copies.drop("_pieces").join(spread, [on, "_piece"], "inner").drop("_piece")


def key_set(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys, written once: three existence filters share them."""
    return materialize(df.where(F.col(key).isNotNull()).select(key).distinct(), "keys")


def having_key(df: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows whose key is in ``keys`` (from ``key_set``).

    Few keys are broadcast and ``df`` is not shuffled. Otherwise both sides are shuffled straight
    from scans, which lets AQE split a key that holds a large part of ``df``.
    """
    return having_keys({"": df}, keys, on, limit)[""]


def having_keys(
    tables: dict[str, DataFrame], keys: DataFrame, on: str, limit: int = BROADCAST_LIMIT
) -> dict[str, DataFrame]:
    """``having_key`` for several tables, the keys measured once."""
    ((side, _),) = broadcast_if_small(keys, limit=limit)
    return {name: df.join(side, on, "left_semi") for name, df in tables.items()}
