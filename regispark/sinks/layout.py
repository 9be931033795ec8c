"""Tables laid out by key, with a directory of their files that lookups read first."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.sinks.tables import clustered

ROWS_PER_FILE = 1_000_000
#: Rows that a task sorts at least, once there are ``FEW_PARTS`` tasks; it cuts them into its files.
PART_ROWS = 250_000
FEW_PARTS = 256
#: Bytes of a row group: what a lookup reads at least.
GROUP_BYTES = 16 * 1024 * 1024


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], *, rows_per_file: int = ROWS_PER_FILE, mode: str = "errorifexists"
) -> None:
    """Files of about ``rows_per_file`` rows, in ranges of ``keys`` and sorted by them.

    Keys that hold more rows than a file are split over several. Many small files are cut from fewer sorted
    parts, as every task sends a piece to each part. Each row group has a Bloom
    filter per key, sized by the values measured. ``df`` is read several times: give a written table.
    """
    distinct = [F.approx_count_distinct(k).alias(f"d{i}") for i, k in enumerate(keys)]
    told = df.agg(F.count("*").alias("n"), *distinct).first()
    files = max(1, math.ceil(told["n"] / rows_per_file))
    parts = min(files, max(FEW_PARTS, math.ceil(told["n"] / PART_ROWS)))
    writer = clustered(df, *keys, files=parts, hot_rows=rows_per_file).write.mode(mode)
    if parts < files:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    for i, key in enumerate(keys):
        values = max(1, math.ceil(1.2 * told[f"d{i}"] / files))
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(values))
    writer.option("parquet.block.size", str(GROUP_BYTES)).parquet(path)


def file_directory(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file of a table read from files: ``file``, ``rows``, and the least and greatest of each
    key as ``<key>_from`` and ``<key>_to``. Only the keys are read."""
    fences = [f for k in keys for f in (F.min(k).alias(f"{k}_from"), F.max(k).alias(f"{k}_to"))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *fences)


def files_with(directory: DataFrame, key: str, values: Sequence[object]) -> list[str]:
    """Files that may hold one of a few values of a key."""
    hit = F.lit(False)
    for value in values:
        hit = hit | (F.lit(value).cast(directory.schema[f"{key}_from"].dataType).between(F.col(f"{key}_from"), F.col(f"{key}_to")))
    return sorted(r["file"] for r in directory.where(hit).select("file").collect())


def lookup(
    spark: SparkSession, directory: DataFrame, like: DataFrame, key: str, values: Sequence[object], base: str | None = None
) -> DataFrame:
    """Rows of ``like`` with one of ``values``, read from the files that may hold them and no others.

    ``like`` gives the schema; ``base`` is the folder below which folder names are partition columns.
    """
    files = files_with(directory, key, values)
    wanted = F.col(key).isin(list(values))
    if not files:
        return like.where(F.lit(False))
    reader = spark.read.schema(like.schema)
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(*files).where(wanted)
