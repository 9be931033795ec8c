"""Tables with every coded column described."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regispark.functions.codes import split_codes
from regispark.functions.values import padded_code
from regispark.operators.joins import company_establishment, lookups, used_entries
from regispark.operators.sizing import BROADCAST_LIMIT, measured_bytes
from regispark.schemas import ACTIVITY_CODE_WIDTH, LINKS, code_links, list_links

#: Bytes of the largest dictionary that is made a constant of a plan.
CONSTANT_LIMIT = 8 * 1024 * 1024


def enrich(
    table: str,
    df: DataFrame,
    dictionaries: dict[str, DataFrame],
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Adds ``<column>_descricao`` for each declared link of ``table`` into a given dictionary: a text, or for
    a column that lists codes an array with the text of each, in list order."""
    for link in list_links(table):
        if link.target in dictionaries and link.column in df.columns:
            df = described_list(df, link.column, dictionaries[link.target], f"{link.column}_descricao", limit=limit)
    links = [link for link in code_links(table) if link.target in dictionaries]
    steps, helpers = [], []
    for link in links:
        on = link.column
        if link.target == "cnae":
            # Activity codes are text with leading zeros, the establishment holds a number.
            on = f"_{link.column}"
            df = df.withColumn(on, padded_code(F.col(link.column), ACTIVITY_CODE_WIDTH))
            helpers.append(on)
        steps.append((dictionaries[link.target], on, f"{link.column}_descricao"))
    if not steps:
        return df
    return lookups(df, steps, limit=limit).drop(*helpers)


def described_list(
    df: DataFrame,
    column: str,
    dictionary: DataFrame,
    described: str,
    *,
    code: str = "codigo",
    value: str = "descricao",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Adds an array with the description of each code of a comma list, in order; NULL for unknown codes, and
    for a NULL list. Of a code listed twice in the dictionary the greatest description counts.

    The dictionary is dealt into small lists by a hash of the code, so that one code is looked up among
    about one entry; if all of them, or else those whose codes are listed, are within ``limit`` and
    ``CONSTANT_LIMIT`` they are a constant of the plan, and ``df`` stays as it is. Otherwise the codes of all lists are joined, one row each with its place, and put together
    by list: what is shuffled is codes and descriptions, and each list once.
    """
    texts = dictionary.groupBy(F.col(code).cast("string").alias("code")).agg(F.max(value).alias("text"))
    texts = texts.where(F.col("code").isNotNull())
    codes = split_codes(F.col(column))
    few = min(limit, CONSTANT_LIMIT)
    fits = measured_bytes(texts)[0] <= few
    if not fits and few > 0:
        listed = df.where(F.col(column).isNotNull()).select(F.explode(codes).alias("listed"))
        entries, _ = used_entries(dictionary.select(F.col(code).cast("string").alias("code"), value), "code", listed, limit)
        texts = entries.groupBy("code").agg(F.max(value).alias("text"))
        fits = measured_bytes(texts)[0] <= few
    if fits:
        count = max(1, 2 * texts.count())
        dealt: list[list[dict]] = [[] for _ in range(count)]
        bucket = F.pmod(F.xxhash64("code"), F.lit(count)).alias("bucket")
        for row in texts.select(bucket, "code", "text").collect():  # within the limit
            dealt[row["bucket"]].append({"code": row["code"], "text": row["text"]})
        # Folded into a constant by the optimizer; as a column it would be copied into every row.
        held = F.from_json(F.lit(json.dumps(dealt)), "array<array<struct<code:string,text:string>>>")

        def text(c: Column) -> Column:
            own = F.get(held, F.pmod(F.xxhash64(c), F.lit(count)).cast("int"))
            return F.get(F.filter(own, lambda x: x["code"] == c), F.lit(0))["text"]

        return df.withColumn(described, F.transform(codes, text))
    lists = df.where(F.col(column).isNotNull()).select(column).distinct()
    items = lists.select(column, F.posexplode(codes).alias("place", "code")).join(texts.hint("merge"), "code", "left")
    joined = items.groupBy(column).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]).alias(described)
    )
    return df.join(joined.withColumnRenamed(column, "_list"), F.col(column) == F.col("_list"), "left").drop("_list")


def related(source: str, target: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Left join along the declared base-key relationship of two tables.

    Columns other than the key are prefixed with the name of their table.
    """
    (link,) = [
        link
        for link in LINKS
        if (link.source, link.target) == (source, target) and link.column == link.target_column
    ]
    sides = [
        df.select(
            link.column,
            *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != link.column],
        )
        for name, df in ((source, tables[source]), (target, tables[target]))
    ]
    return company_establishment(*sides, link.column)
