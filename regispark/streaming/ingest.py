"""Incremental ingest: each new file once, in bounded batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from regispark.operators.typing import typed
from regispark.schemas import Table
from regispark.sources.delimited import FILE, parse_lines, without_missing
from regispark.sources.files import is_leftover

FILES_PER_BATCH = 1000


def stream_files(
    spark: SparkSession,
    folder: str,
    columns: list[tuple[str, str]],
    *,
    glob: str = "*",
    files_per_batch: int = FILES_PER_BATCH,
    encoding: str = "cp1252",
    on_error: str = "fail",
    full_key: Sequence[str] = (),
    na_tokens: Sequence[str] = (),
) -> DataFrame:
    """Typed rows of files as they arrive, with the same cleaning and typing as the batch scan; the full key
    too, where its parts are given.

    A file counts as new by its path: publish changed files under new names, or use
    ``streaming.files``.
    """
    lines = (
        spark.readStream.format("text")
        .option("lineSep", "\n")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .withColumn(FILE, F.col("_metadata.file_name"))
    )
    names = [name for name, _ in columns]
    lines = lines.where(~is_leftover(F.col(FILE)))
    rows = parse_lines(lines, names, encoding=encoding, on_error=on_error)
    rows = without_missing(rows, names, na_tokens)
    return typed(rows, columns, full_key, on_error)


def stream_table(spark: SparkSession, folder: str, table: Table, **options) -> DataFrame:
    """``stream_files`` of the files whose names hold a registry table's token, typed as that table."""
    columns = list(table.columns)
    return stream_files(spark, folder, columns, glob=f"*{table.token}*", full_key=table.full_key, **options)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to Parquet files and stop; each run goes on where the last one ended.

    The file sink's log makes a batch appear whole or not at all, also after a restart.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    query = (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
