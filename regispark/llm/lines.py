"""Line dedup: repeated runs of lines, found by a suffix array over line ids.

Every document is a sequence of line ids (white space normalised; blank lines are skipped). The
suffix array is built by distributed prefix doubling: level 0 ranks the lines, level k + 1 ranks
the pairs (rank of a place, rank of the place 2^k lines on). Suffixes of equal rank at level k
are an interval whose longest common prefix is 2^k or more. A rank that only one suffix has is settled
and drops out, so each level works on repeated runs only.

A run of at least ``MIN_WORDS`` words that occurs earlier, in order of document id and line, is
deleted; the first copy stays. Every such run is a union of shortest windows of that many words,
one from each of its lines on and one up to each, so doubling stops at the longest window. A
window of m lines is the interval of equal ranks of its first and last 2^k lines, k = floor(log2 m);
the interval's leftmost member stays, and overlapping later copies join into the maximal runs that
are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regispark.llm.frames import materialize, ship, small_batches
from regispark.operators.joins import broadcast_if_small

#: Fewest words of a run that is deleted.
MIN_WORDS = 50
LINES = (
    "doc_id bigint, text_hash bigint, pos int, at int, line_high bigint, line_low bigint, from_here int, up_to_here int"
)


def line_ids(text: str) -> tuple[list[int], list[bytes], list[int]]:
    """Line numbers of the non-blank lines, their 128-bit ids, and their words."""
    places, ids, words = [], [], []
    for at, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        parts = line.split()
        if parts:
            places.append(at)
            ids.append(xxhash.xxh3_128_digest(b" ".join(parts)))
            words.append(len(parts))
    return places, ids, words


def shortest_windows(words: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, how many lines from it on, and up to it, first hold ``least`` words; 0 if none."""
    through = np.cumsum(words)
    before = through - words
    place = np.arange(len(words))
    last = np.searchsorted(through, before + least)
    first = np.searchsorted(before, through - least, side="right") - 1
    return np.where(last < len(words), last - place + 1, 0), np.where(first >= 0, place - first + 1, 0)


def line_table(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Non-blank lines: document, place among them, line number, id, and shortest windows."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                places, ids, words = line_ids(text)
                if not places:
                    continue
                n = len(places)
                line = np.frombuffer(b"".join(ids), ">i8").astype(np.int64).reshape(n, 2)
                forward, backward = shortest_windows(words, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * n, pa.int64()), pa.array([own] * n, pa.int64()),
                        pa.array(np.arange(n, dtype=np.int32)), pa.array(places, pa.int32()),
                        pa.array(line[:, 0].copy()), pa.array(line[:, 1].copy()),
                        pa.array(forward.astype(np.int32)), pa.array(backward.astype(np.int32)),
                    ],
                    [part.split()[0] for part in LINES.split(", ")],
                )

    rows = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return rows.mapInArrow(run, LINES)


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` whose values of ``by`` others share, with their ``rank``.

    The distinct values are counted (combined before the shuffle), sorted by range over many tasks
    and numbered in that order; all rows that hold one get its number.
    """
    held = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    order = held.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("new", F.monotonically_increasing_id())
    # Written before use: a number must not change when a task runs again.
    order = materialize(order, "order")
    kept = [c for c in rows.columns if c not in (*by, "rank")]
    return rows.join(order, by).select(*kept, F.col("new").alias("rank"))


def suffix_ranks(repeated: DataFrame, longest: int) -> list[DataFrame]:
    """``doc``, ``pos`` and ``rank`` at each level up to ``longest`` lines; settled suffixes left out."""
    levels, reach = [repeated.select("doc", "pos", "rank")], 1
    while 2 * reach <= longest:
        ahead = Window.partitionBy("doc").orderBy("pos").rangeBetween(reach, reach)
        pairs = levels[-1].withColumn("next", F.min("rank").over(ahead)).where(F.col("next").isNotNull())
        pairs = materialize(pairs.withColumnRenamed("rank", "first"), "pairs")
        levels.append(materialize(_ranked(pairs, ["first", "next"]), "ranks"))
        reach *= 2
    return levels


def later_copies(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``lines``, the line numbers to delete, of documents that hold any."""
    lines = line_table(docs, least).dropDuplicates(["doc_id", "text_hash", "pos"])
    lines = materialize(lines.withColumn("doc", F.struct("doc_id", "text_hash")).drop("doc_id", "text_hash"), "lines")
    repeated = materialize(_ranked(lines, ["line_high", "line_low"]), "repeated")
    longest = repeated.agg(F.max(F.greatest("from_here", "up_to_here"))).first()[0] or 0
    levels = suffix_ranks(repeated, longest)
    windows = repeated.select("doc", "pos", F.col("from_here").alias("m")).unionByName(
        repeated.select("doc", (F.col("pos") - F.col("up_to_here") + 1).alias("pos"), F.col("up_to_here").alias("m"))
    )
    windows = windows.where("m > 0").distinct()
    named = None
    for k, ranks in enumerate(levels):
        fitting = windows.where((F.col("m") >= 1 << k) & (F.col("m") < 2 << k)).withColumn(
            "end", (F.col("pos") + F.col("m") - (1 << k)).cast("int")
        )
        ends = ranks.select("doc", F.col("pos").alias("end"), F.col("rank").alias("last"))
        one = fitting.join(ranks.withColumnRenamed("rank", "first"), ["doc", "pos"])
        one = one.withColumn("last", F.lit(0).cast("bigint")) if k == 0 else one.join(ends, ["doc", "end"])
        one = one.select("doc", "pos", "m", "first", "last")
        named = one if named is None else named.unionByName(one)
    named = materialize(named, "windows")
    leftmost = named.groupBy("m", "first", "last").agg(
        F.min(F.struct("doc", "pos")).alias("leftmost"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    later = named.join(leftmost, ["m", "first", "last"]).where(F.struct("doc", "pos") > F.col("leftmost"))
    gone = later.select("doc", F.explode(F.sequence("pos", F.col("pos") + F.col("m") - 1)).alias("pos")).distinct()
    found = gone.join(lines.select("doc", "pos", "at"), ["doc", "pos"])
    return found.groupBy("doc").agg(F.collect_list("at").alias("lines")).select(
        "doc.doc_id", "doc.text_hash", "lines"
    )


def deduplicated(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs of lines deleted from ``text``, and the columns
    ``n_lines`` and ``n_deleted``, in place of columns of those names.

    Reads ``doc_id`` and ``text``. Lines are equal if their words are; ``n_lines`` counts all
    lines, blank ones too, which stay. A null text stays null and has no lines. Rows alike in id
    and text are one document; rows with the same id but other texts go by a hash of the text; null
    ids come first. Empty input gives no rows. Documents without a repeated run stay as they were.
    """
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_deleted")]
    ((copies, _),) = broadcast_if_small(materialize(later_copies(docs, least), "copies"))
    # The caller's columns travel in a struct, so that none has the name of one made here.
    rows = docs.select("doc_id", "text", F.struct(*others).alias("doc"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("a.text") == F.col("b.text_hash"))
    joined = rows.alias("a").join(copies.alias("b"), same, "left").select("doc", "text", F.col("b.lines").alias("gone"))
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    )
    return joined.select(
        *(F.col("doc")[c].alias(c) for c in others),
        text.alias("text"),
        F.coalesce(F.size(split), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"),
    )


def without_copies(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Documents without later copies of repeated runs, with ``n_chars`` of the text that is left and
    their other columns as they were. A document that was nothing but later copies goes; one that
    had no word to begin with stays."""
    done = deduplicated(docs, least)
    left = F.length(F.translate(F.coalesce("text", F.lit("")), " \t\n\x0b\x0c\r", "")) > 0
    kept = done.where((F.col("n_deleted") == 0) | left)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)
