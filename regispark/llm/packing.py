"""Packing documents into batches of one padded length.

The lengths of all documents are counted; dynamic programming over that histogram chooses the
bucket lengths for which padding every document to its bucket's length wastes least. Inside a
bucket, batches are formed of as many rows as a token budget holds.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regispark.llm.frames import materialize, words
from regispark.operators.sizing import heavy_keys, split_by_keys

BUCKETS = 16
#: Tokens of a batch, padding included; a longer document is a batch by itself.
BUDGET = 65_536
#: Rows of a shard, in which one task numbers rows.
SHARD_ROWS = 50_000


def counted_length(length: Column, fine: int | None = None) -> Column:
    """The length a document counts as in the histogram: itself, or with ``fine`` rounded up by less than
    one part in ``fine`` / 2."""
    if fine is None:
        return length.cast("bigint")
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(fine)).cast("double") / fine))).cast("bigint")
    return (F.ceil(length / step) * step).cast("bigint")


def best_lengths(histogram: Sequence[tuple[int, int]], buckets: int) -> list[int]:
    """Bucket lengths, ascending, with the least padding for (length, documents) pairs.

    With L the lengths, C and S the running sums of documents and of their lengths, a bucket that
    ends at j and starts after i wastes L[j] (C[j] - C[i]) - (S[j] - S[i]). For a given number of
    buckets, the best i for each j is a minimum over lines in L[j] of falling slope -C[i], so
    the lines' lower hull is walked once: O(buckets * lengths). Among equally good choices the one
    with the fewest buckets is taken. No lengths give no buckets.
    """
    rows = sorted((length, n) for length, n in histogram if n > 0)
    if not rows:
        return []
    # Plain arrays of numbers: there may be millions of lengths.
    lengths = array("q", (length for length, _ in rows))
    docs, tokens = array("q", [0]), array("q", [0])
    for length, n in rows:
        docs.append(docs[-1] + n)
        tokens.append(tokens[-1] + length * n)
    count = len(rows)
    unknown = -1
    waste = array("q", [0]) + array("q", [unknown]) * count  # of the first j lengths in 0 buckets: only none at all
    choices: list[array] = []
    best = None
    for _ in range(min(buckets, count)):
        # Lines as place i and height; the slope is -docs[i].
        hull, heights = array("q"), array("q")
        head = 0
        new, choice = array("q", [unknown]) * (count + 1), array("i", [0]) * (count + 1)
        for j in range(1, count + 1):
            i = j - 1
            if waste[i] != unknown:
                line = (-docs[i], waste[i] + tokens[i])
                while len(hull) - head >= 2 and _covered(
                    (-docs[hull[-2]], heights[-2]), (-docs[hull[-1]], heights[-1]), line
                ):
                    hull.pop()
                    heights.pop()
                hull.append(i)
                heights.append(line[1])
            if head == len(hull):
                continue
            at = lengths[j - 1]
            while len(hull) - head >= 2 and (
                heights[head + 1] - docs[hull[head + 1]] * at <= heights[head] - docs[hull[head]] * at
            ):
                head += 1
            i = hull[head]
            new[j], choice[j] = heights[head] - docs[i] * at + at * docs[j] - tokens[j], i
        waste = new
        choices.append(choice)
        if waste[count] != unknown and (best is None or waste[count] < best[0]):
            best = (waste[count], len(choices))
    ends, j = [], count
    for k in range(best[1], 0, -1):
        ends.append(lengths[j - 1])
        j = choices[k - 1][j]
    return ends[::-1]


def _covered(a: tuple[int, int], b: tuple[int, int], c: tuple[int, int]) -> bool:
    """Whether the line ``b`` is nowhere below both ``a`` and ``c``, which have more and less slope."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def packed(
    docs: DataFrame, length: str, key: Sequence[str], buckets: int = BUCKETS, budget: int = BUDGET, fine: int | None = None
) -> DataFrame:
    """``docs`` with ``bucket_length``, ``batch`` and ``place``, in place of columns of those names.

    A batch is named by its bucket's length, its shard and its number: it has
    ``max(1, budget // bucket_length)`` places, counted from 0. Rows are dealt into shards by a hash
    of ``key``, so that no task numbers more than a bounded part of a bucket however many rows it
    holds, and go by length and ``key`` inside it; rows alike in both are in any order. Rows of a
    ``key`` that more than a shard's rows hold are dealt by their place in ``docs``, which is to be a
    written table. The last batch of a shard may be part full. A null length counts as 0, and
    length 0 has a bucket like any other length. No row is dropped or cut. Empty input gives no rows.

    The histogram of lengths, which the driver gets, has one entry for each length there is: fewer
    than the square root of twice all tokens. ``fine`` rounds lengths for it, and so bounds it at about 64
    times ``fine`` entries, at the price of boundaries that are best for rounded lengths.
    """
    others = [c for c in docs.columns if c not in ("bucket_length", "batch", "place")]
    keys = [f"key_{k}" for k in range(len(key))]
    whole = F.coalesce(F.col(length), F.lit(0)).cast("bigint")
    # The caller's columns travel in a struct, so that none has the name of one made here.
    sized = docs.select(
        F.struct(*others).alias("doc"), whole.alias("length"), *[F.col(c).alias(k) for c, k in zip(key, keys)]
    ).withColumn("counted", counted_length(F.col("length"), fine))
    told = sized.groupBy("counted").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).toArrow()
    counted, number, most = (told.column(c).to_pylist() for c in ("counted", "n", "longest"))
    histogram = list(zip(counted, number))
    # A bucket's own length is that of its longest document, which rounding may have raised.
    longest = dict(zip(counted, most))
    ends = best_lengths(histogram, buckets) or [0]
    rows = [0] * len(ends)
    for size, n in histogram:
        rows[bisect_left(ends, size)] += n
    fitting = F.lit(longest.get(ends[-1], 0))
    shards = F.lit(1 + rows[-1] // SHARD_ROWS)
    for end, n in zip(reversed(ends[:-1]), reversed(rows[:-1])):
        inside = F.col("counted") <= end
        fitting = F.when(inside, F.lit(longest[end])).otherwise(fitting)
        shards = F.when(inside, F.lit(1 + n // SHARD_ROWS)).otherwise(shards)
    hot = heavy_keys(sized, *keys, min_rows=SHARD_ROWS)
    placed = sized.withColumn("dealt", F.xxhash64(*keys))
    if not hot.isEmpty():
        few, many = split_by_keys(sized.withColumn("dealt", F.monotonically_increasing_id()), hot, *keys)
        placed = few.withColumn("dealt", F.xxhash64(*keys)).unionByName(many.withColumn("dealt", F.xxhash64("dealt")))
    in_shard = Window.partitionBy("bucket_length", "shard").orderBy("counted", *keys)
    numbered = (
        placed.withColumn("bucket_length", fitting.cast("bigint"))
        .withColumn("shard", F.pmod("dealt", shards).cast("bigint"))
        .withColumn("row", F.row_number().over(in_shard) - 1)
    )
    places = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1)))).cast("bigint")
    batch = F.concat_ws("-", "bucket_length", "shard", F.floor(F.col("row") / places).cast("bigint"))
    return numbered.select(
        *[F.col("doc")[c].alias(c) for c in others],
        "bucket_length",
        batch.alias("batch"),
        F.pmod(F.col("row"), places).cast("bigint").alias("place"),
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` (words of the whole text, none for null), ``bucket_length``,
    ``batch`` and ``place`` of every row."""
    # Counted once: the histogram and the numbering read what was written.
    lengths = docs.select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_tokens"))
    return packed(materialize(lengths, "lengths"), "n_tokens", ["doc_id"])
