"""Settings and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.session import materialize, scratch_path, ship

__all__ = ["materialize", "scratch_path", "ship", "small_batches", "words", "DOCUMENTS", "WORD_GAP"]

#: Rows of an Arrow batch: whole texts travel in them, so few at a time bound a worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
#: Columns of the documents table, which filtering stages keep.
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What separates words: blank, and the control characters 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """Keeps the Arrow batches that Python workers get small, in rows and in bytes.

    A setting of the session, and it stays: what an operator returns is run later. Sessions that hand
    larger batches to Python elsewhere set it again.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def words(text: Column) -> Column:
    """Words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")

