"""Writing and maintaining tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.operators.sizing import HOT_ROWS, heavy_keys, split_by_keys, with_place
from regispark.sources.delimited import BLANKS, FORMAT

# Fixed value: rows per insert.
DATABASE_BATCH = 4096
DATABASE_CONNECTIONS = 16


def replace_table(df: DataFrame, table: str, *, partition_by: list[str] | None = None) -> None:
    """Full refresh: build under a new name, then swap, so that readers of the old table and a
    failed job leave it whole; ``df`` may read the table it replaces."""
    spark = df.sparkSession
    fresh = f"{table}__new"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(fresh)
    swap_table(spark, fresh, table)


def swap_table(spark: SparkSession, fresh: str, table: str) -> None:
    """Give the name of ``table`` to ``fresh``. The old table is renamed aside first and dropped last;
    if the second rename fails it gets its name back."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        return
    aside = f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {aside}")


def append_table(df: DataFrame, table: str) -> None:
    """Add rows; nothing is deduplicated."""
    df.write.format("parquet").mode("append").saveAsTable(table)


def write_indexed(df: DataFrame, table: str, *keys: str) -> None:
    """Table with a Bloom filter per key and row group: a lookup by key skips nearly all row
    groups, in whatever order the rows come. Needs no shuffle."""
    writer = df.write.format("parquet").mode("overwrite")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.saveAsTable(table)


def clustered(df: DataFrame, *keys: str, files: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows range-partitioned and sorted by key, for files whose min/max ranges hardly overlap.

    Meant for a written table: the ranges are sampled from it first. A set of keys that holds very many
    rows is split over several files; only its rows are given places to split them by.
    """
    count = [files] if files else []
    hot = heavy_keys(df, *keys, min_rows=hot_rows)
    if hot.isEmpty():
        return df.repartitionByRange(*count, *keys).sortWithinPartitions(*keys)
    others, alike = split_by_keys(df, hot, *keys)
    placed = others.withColumn("_place", F.lit(None).cast("bigint")).unionByName(with_place(alike, "_place"))
    placed = placed.repartitionByRange(*count, *keys, "_place")
    return placed.sortWithinPartitions(*keys).drop("_place")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Bucketed and sorted by key, so that joins on it need no shuffle.

    A bucket is read by one task, which rules it out where a key holds very many rows: that is an
    error. Such a table is to be ``clustered``; joins on it shuffle, and AQE can split the key.
    """
    hot = heavy_keys(df, key, min_rows=hot_rows).limit(3).collect()
    if hot:
        told = ", ".join(f"{row[key]} ({row['n']} rows)" for row in hot)
        raise ValueError(f"too many rows of one {key} for a bucket: {told}")
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def analyze(spark: SparkSession, table: str, *columns: str) -> None:
    """Row count and column statistics for the cost-based choices; without names, all columns."""
    which = f"COLUMNS {', '.join(columns)}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")


def drop_tables(spark: SparkSession, *tables: str) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_snapshot(df: DataFrame, root: str, value: object, column: str = "snapshot") -> None:
    """One publication as a partition folder; other publications below ``root`` stay."""
    df.write.mode("overwrite").parquet(f"{root}/{column}={value}")


def write_delimited(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    """Header-less delimited files in the format the scan reads: NULL is an empty field, an empty
    string a quoted one."""
    df.write.options(**FORMAT, **BLANKS).option("encoding", encoding).csv(path)


def write_database(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batch: int = DATABASE_BATCH,
    connections: int = DATABASE_CONNECTIONS,
    **options: str,
) -> None:
    """Append rows to a database table in batches, over at most ``connections`` at a time.

    A task that is run again inserts its rows again: give ``table`` a staging name and move the
    rows inside the database where that matters.
    """
    writer = df.write.format("jdbc").mode("append")
    target = {"url": url, "dbtable": table, "batchsize": batch, "numPartitions": connections}
    writer.options(**target, **options).save()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
