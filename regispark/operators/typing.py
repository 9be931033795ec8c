"""Staging text to typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regispark.functions import values
from regispark.schemas import FULL_KEY, Table
from regispark.sources.delimited import CORRUPT

REJECTED = "_rejected"


def type_table(
    staging: DataFrame, table: Table, on_error: str = "fail", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed projection of an all-text table, with the full key where the table has one, and the columns
    ``keep`` as they are.

    ``on_error="fail"`` stops the job that computes a value which cannot be typed.
    ``"quarantine"`` leaves NULL and lists column and raw value in ``_rejected``, which is NULL
    for clean rows; a raw line the scan put into ``_corrupt`` is passed on.
    """
    return typed(staging, table.columns, table.full_key, on_error, keep)


def typed(
    staging: DataFrame,
    columns: Sequence[tuple[str, str]],
    full_key: Sequence[str] = (),
    on_error: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    mode = values.FAIL if on_error == "fail" else values.NULL
    kinds = dict(columns)
    out = [values.typed(F.col(name), kind, mode).alias(name) for name, kind in columns]
    if full_key:
        parts = [values.typed(F.col(name), kinds[name]) for name in full_key]
        out.append(values.full_key(*parts).alias(FULL_KEY))
    if on_error == "quarantine":
        out.append(_rejects(columns).alias(REJECTED))
        corrupt = F.col(CORRUPT) if CORRUPT in staging.columns else F.lit(None).cast("string")
        out.append(corrupt.alias(CORRUPT))
    return staging.select(*out, *keep)


def split_rejected(typed_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantine result into the table, with rejected values NULL and without corrupt lines, and
    the rows that have either."""
    whole = F.col(CORRUPT).isNull()
    rejects = typed_rows.where(F.col(REJECTED).isNotNull() | ~whole)
    return typed_rows.where(whole).drop(REJECTED, CORRUPT), rejects


def _rejects(columns: Sequence[tuple[str, str]]) -> Column:
    found = [
        F.when(
            values.is_rejected(F.col(name), kind),
            F.struct(
                F.lit(name).alias("column"),
                F.col(name).alias("value"),
                F.lit(f"not a valid {kind}").alias("reason"),
            ),
        )
        for name, kind in columns
        if values.can_fail(kind)
    ]
    if not found:
        return F.lit(None).cast("array<struct<column:string,value:string,reason:string>>")
    listed = F.array_compact(F.array(*found))
    return F.when(F.size(listed) > 0, listed)
