"""File listings: routing by name, what to fetch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.schemas import TABLES


#: Ending of the files that a load leaves behind.
LEFTOVER = ".tmp.csv"


def list_files(spark: SparkSession, folder: str | Sequence[str], glob: str = "*") -> DataFrame:
    """``(name, path, size)`` of a folder's files, or of the files named; contents are not read."""
    paths = folder if isinstance(folder, str) else list(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("name"), "path", F.col("length").alias("size"))


def is_leftover(name: Column) -> Column:
    """Whether a file is what a load left behind; wherever files come from, such are not read."""
    return F.lower(name).endswith(LEFTOVER)


def is_archive(name: Column) -> Column:
    return F.lower(name).endswith(".zip")


def route_files(listing: DataFrame, name: str = "name") -> DataFrame:
    """One row per file and table whose token the name contains; leftovers of a load are skipped."""
    tokens = F.array(
        *[
            F.when(F.col(name).contains(t.token), F.lit(t.name))
            for t in TABLES.values()
        ]
    )
    kept = listing.where(~is_leftover(F.col(name)))
    return kept.withColumn("table", F.explode(F.array_compact(tokens)))


def manifest_diff(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote listing ``(name, size, status)`` with ``fetch``: true if the file is missing from
    ``local (name, size)``, the server did not answer 200, or its size is known and differs.

    One answer per remote row: a name listed locally more than once, say in several folders, is fetched
    unless all its copies have the size.
    """
    size = F.col("size").cast("bigint")
    copies = local.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("_have"))
    have = copies.agg(
        F.min(size).alias("local_size"),
        F.coalesce(F.min(size) != F.max(size), F.lit(False)).alias("_differ"),
    )
    size = F.col("size")
    fetch = (
        F.when(F.col("_have").isNull(), True)
        .when(F.coalesce(F.col("status"), F.lit(0)) != 200, True)
        .when(
            (F.coalesce(size, F.lit(0)) != 0) & (F.col("_differ") | F.coalesce(size != F.col("local_size"), F.lit(False))),
            True,
        )
        .otherwise(False)
    )
    joined = remote.join(have, remote["name"] == have["_have"], "left")
    return joined.withColumn("fetch", fetch).drop("_have", "_differ")
