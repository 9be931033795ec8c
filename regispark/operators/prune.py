"""Keep active establishments and the rows of companies that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.operators.joins import having_keys, key_set
from regispark.operators.sizing import BROADCAST_LIMIT
from regispark.schemas import ACTIVE_STATUS, KEY


def active_only(
    establishments: DataFrame,
    *,
    status: str = "situacao_cadastral",
    active: object = ACTIVE_STATUS,
    special: str = "situacao_especial",
    exclude_special: bool = False,
) -> DataFrame:
    """Establishments in active status; on request also without a special situation."""
    kept = establishments.where(F.col(status) == F.lit(active))
    if exclude_special:
        kept = kept.where(F.col(special).isNull() | (F.col(special) == ""))
    return kept


def prune(
    tables: dict[str, DataFrame],
    active: DataFrame,
    *,
    key: str = KEY,
    limit: int = BROADCAST_LIMIT,
) -> dict[str, DataFrame]:
    """Semi-join every table to the keys of ``active``; duplicates of a key do not multiply rows."""
    return having_keys(tables, key_set(active, key), key, limit)
