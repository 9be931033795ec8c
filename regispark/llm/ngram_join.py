"""N-gram Jaccard join by count vectors and R-trees.

A document is the set of its five-word shingles. Its shingles' hashes are dealt into groups, and
the group counts are a point. Two sets share at most the sum of the smaller coordinates of their
points; for a node of an R-tree, whose box has a largest count per group, the sum of the minima
with the box bounds what any point inside can share. Pairs whose bound reaches the overlap that
the likeness asks for are verified on the whole sets.

Trees are built per bucket, so that documents far apart never meet. Linked documents share a shingle
among the first ``n - ceil(0.8 n) + 1`` of each in any common order of shingles; the order here
is by hash, shingles of more than ``HOT`` buckets' size last. A bucket is one such shingle.

* Documents with equal sets go by their smallest id from the start.
* A document whose listed shingles are mostly hot cannot tell its prefix in that order; it is *heavy*
  and meets every document by the plain order by hash, in which all others list theirs too.
* Near copies fill many buckets. First every document is compared with its buckets' leaders, then
  those outside a bucket's largest component with more of its members, and only buckets that still hold several components get trees, for pairs across components. No link
  between components is lost, and no pair inside one is needed.
* A bucket larger than ``BLOCK`` is dealt into blocks, and each pair of blocks is a task's unit. The heavy
  documents of a bucket have blocks of their own, which meet all others; these do not meet each other for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regispark.llm.components import components
from regispark.llm.frames import materialize, ship, small_batches
from regispark.operators.joins import broadcast_if_small

#: Words of a shingle, and the likeness of linked sets in percent.
WIDTH = 5
PERCENT = 80
#: Shingles that more documents list are compared last.
HOT = 200
#: Documents of a bucket that are compared in one piece.
BLOCK = 3000
#: Points of a leaf, and nodes of an inner node.
FAN = 16
#: Buckets of more documents hold fine points.
LARGE = 256
FEWEST_GROUPS, MOST_GROUPS = 16, 1 << 16
#: Bytes of text that are hashed at a time, and rows whose bounds are computed at a time.
AT_ONCE = 1 << 20
ROWS = 4096
#: Pairs that a task remembers, pairs that it hands on at a time, and pairs that a tree is asked for at a time.
TOLD = 500_000
TOLD_AT_ONCE = 1 << 16
ASKED = 1 << 19

BASE = 0x9E3779B97F4A7C15
GAP = np.zeros(256, bool)
GAP[[32, *range(9, 14)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class _Powers:
    """Powers of the base modulo 2^64, and of its inverse, as far as they have been needed."""

    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def upto(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < count:
            step = pow(BASE, len(cls.up), 1 << 64)
            cls.up = np.concatenate((cls.up, cls.up * np.uint64(step)))
            cls.down = np.concatenate((cls.down, cls.down * np.uint64(pow(step, -1, 1 << 64))))
        return cls.up, cls.down


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; a word's hash is a difference of prefix hashes."""
    raw = np.frombuffer(data, np.uint8)
    word = np.concatenate(([False], ~GAP[raw], [False]))
    starts = np.nonzero(word[1:] & ~word[:-1])[0]
    ends = np.nonzero(word[:-1] & ~word[1:])[0]
    up, down = _Powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(held[-1]) + 1
        if size >= AT_ONCE:
            yield from _sets(held)
            held, size = [], 0
    if held:
        yield from _sets(held)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    hashes, starts = _word_hashes(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    multipliers = [np.uint64(pow(BASE, 3 * k + 1, 1 << 64)) for k in range(WIDTH)]
    count = max(0, len(hashes) - WIDTH + 1)
    rolled = np.zeros(count, np.uint64)
    for k, m in enumerate(multipliers):
        rolled += hashes[k : k + count] * m
    rolled = _mixed(rolled)
    first = 0
    for last in upto.tolist():
        words = last - first
        if words >= WIDTH:
            own = np.sort(rolled[first : last - WIDTH + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif words:
            whole = np.uint64(words)
            for h in hashes[first:last]:
                whole = _mixed(np.array([whole]) * np.uint64(BASE) + h)[0]
            yield np.array([whole])
        else:
            yield np.empty(0, np.uint64)
        first = last


def overlap_needed(a, b, percent: int = PERCENT):
    """Fewest common shingles of linked sets of the sizes a and b."""
    return -(-(a + b) * percent // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-n * percent // 100) + 1


def listed_length(n: int, percent: int = PERCENT) -> int:
    """Shingles that a document lists: its prefix, and some to take the place of hot ones."""
    prefix = prefix_length(n, percent)
    return min(n, prefix + max(16, prefix // 2))


def groups_for(n: int) -> int:
    """Groups for a set of n shingles, a power of two: one shingle a group or less on average, so that
    few pairs whose points allow a link turn out unlinked."""
    return min(MOST_GROUPS, max(FEWEST_GROUPS, 1 << n.bit_length()))


def coarse(groups: int) -> int:
    """Groups of the points that small buckets hold and that trees are built over. In large buckets
    the pairs that a tree leaves are bounded again by the fine points."""
    return max(FEWEST_GROUPS, groups // 4)


def point(shingles: np.ndarray) -> np.ndarray:
    groups = groups_for(len(shingles))
    return np.bincount((shingles & np.uint64(groups - 1)).astype(np.intp), minlength=groups)


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points over fewer groups: a group's number loses its high bits."""
    if points.shape[1] == groups:
        return points
    halves = points.reshape(points.shape[0], -1, groups).sum(1, dtype=np.uint32)
    return halves.astype(np.uint8) if halves.max(initial=0) < 256 else halves


def bounds(points: np.ndarray, a: np.ndarray, boxes: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the given points and boxes, a bounded number of rows at a time."""
    rows = max(1, ROWS * 64 // points.shape[1])
    return np.concatenate(
        [np.empty(0, np.int64)]
        + [np.minimum(points[a[k : k + rows]], boxes[b[k : k + rows]]).sum(1, dtype=np.int64) for k in range(0, len(a), rows)]
    )


class CountTree:
    """R-tree over count vectors, packed level by level from points sorted by size and projection."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        sign = np.random.default_rng(7).choice((-1, 1), points.shape[1])
        slab = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (FAN * FAN)
        self.order = np.lexsort((points @ sign, slab))
        box, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(box, low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            box, low, high = np.maximum.reduceat(box, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((box, low, high))

    def search(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) numbers of all pairs whose bound reaches the overlap needed."""
        found = list(self.searched(points, sizes, percent))
        return tuple(np.concatenate([np.empty(0, np.intp), *(part[k] for part in found)]) for k in (0, 1))

    def searched(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same by slices of the queries, that have ``ASKED`` pairs at most: near copies all pass the bounds."""
        step = max(1, ASKED // len(self.levels[0][1]))
        for first in range(0, len(points), step):
            query, node = self._search(points[first : first + step], sizes[first : first + step], percent)
            yield query + first, node

    def _search(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        query = np.arange(len(points))
        node = np.zeros(len(points), np.intp)
        for depth in range(len(self.levels) - 1, -1, -1):
            box, low, high = self.levels[depth]
            if depth < len(self.levels) - 1:
                query, node = np.repeat(query, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = node < len(low)
                query, node = query[inside], node[inside]
            own = sizes[query]
            near = (high[node] * 100 >= own * percent) & (low[node] * percent <= own * 100)
            query, node = query[near], node[near]
            partner = np.maximum(low[node], -(-sizes[query] * percent // 100))
            enough = bounds(points, query, box, node) >= overlap_needed(sizes[query], partner, percent)
            query, node = query[enough], node[enough]
        return query, self.order[node]


def described(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For every row: ``doc_id``, ``n`` (set size), ``high`` and ``low`` (128-bit hash of the set),
    ``listed`` (its first shingles by hash), ``fine`` (its point) and ``point`` (over fewer groups)."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1).to_pylist()))
            digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), ">i8").reshape(-1, 2)
            listed = [s[: listed_length(len(s), percent)].astype(np.int64) if len(s) else s.astype(np.int64) for s in sets]
            points = [point(s) for s in sets]
            ends = np.cumsum([0, *map(len, listed)])
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(digest[:, 0].astype(np.int64)),
                pa.array(digest[:, 1].astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(listed))),
                pa.array([_stored(p) for p in points], pa.binary()),
                pa.array([_stored(folded(p[None], coarse(len(p)))[0]) for p in points], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "high", "low", "listed", "fine", "point"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n int, high bigint, low bigint, listed array<bigint>, fine binary, point binary")


def _stored(counts: np.ndarray) -> bytes:
    """Counts as half a byte per group where all are below 16, else as four bytes."""
    if counts.max() < 16:
        return b"\x00" + (counts[0::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    return b"\x04" + counts.astype("<u4").tobytes()


def _loaded(stored: bytes) -> np.ndarray:
    """Counts, in bytes where they are below 16; sums over them are taken in wider numbers."""
    if stored[0]:
        return np.frombuffer(stored, "<u4", offset=1)
    packed = np.frombuffer(stored, np.uint8, offset=1)
    return np.stack((packed & 15, packed >> 4), 1).ravel()


def _groups(stored: bytes) -> int:
    return (len(stored) - 1) // 4 if stored[0] else 2 * (len(stored) - 1)


def _matrix(stored: Sequence[bytes], groups: int) -> np.ndarray:
    """Counts of points over ``groups`` groups or more, one row each, folded to ``groups``, a bounded number of rows
    at a time."""
    sizes = np.array([_groups(x) for x in stored], np.int64)
    packed = np.array([x[0] == 0 for x in stored], bool)
    whole = np.empty((len(stored), groups), np.uint8)
    for size in np.unique(sizes).tolist():
        rows = max(1, ROWS * 64 // size)
        for small in (True, False):
            alike = np.nonzero((sizes == size) & (packed == small))[0]
            for at in (alike[k : k + rows] for k in range(0, len(alike), rows)):
                raw = np.frombuffer(b"".join([stored[k] for k in at.tolist()]), np.uint8).reshape(len(at), -1)[:, 1:]
                if small:
                    counts = np.empty((len(at), size), np.uint8)
                    counts[:, 0::2], counts[:, 1::2] = raw & 15, raw >> 4
                else:
                    counts = np.ascontiguousarray(raw).view("<u4")
                counts = folded(counts, groups)
                whole = whole.astype(np.result_type(whole, counts), copy=False)
                whole[at] = counts
    return whole


def _shared(documents: DataFrame, percent: int) -> DataFrame:
    """The listed shingles by which documents can meet: ``shingle``, ``doc_id``, ``n``, ``heavy``
    (meets all) and ``first`` (meets others that have it so)."""
    told = documents.select("doc_id", "n", F.posexplode("listed").alias("place", "shingle"))
    held = told.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    met = told.join(held, "shingle").select("shingle", "doc_id", "n", "place", (F.col("docs") > HOT).alias("hot"))
    met = materialize(met, "met")
    whole = Window.partitionBy("doc_id")
    before = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    is_hot = F.col("hot").cast("int")
    n, prefix = F.col("n"), F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    listed = F.least(n, prefix + F.greatest(F.lit(16), F.floor(prefix / 2).cast("int")))
    placed = met.withColumns({"hots": F.sum(is_hot).over(whole), "ahead": F.coalesce(F.sum(is_hot).over(before), F.lit(0))})
    placed = placed.withColumns({"listed": listed, "prefix": prefix})
    heavy = (F.col("listed") < F.col("n")) & (F.col("listed") - F.col("hots") < F.col("prefix"))
    place_now = F.when(F.col("hot"), F.col("listed") - F.col("hots") + F.col("ahead")).otherwise(F.col("place") - F.col("ahead"))
    complete_or_cold = ~F.col("hot") | (F.col("listed") == F.col("n"))
    placed = placed.withColumn("heavy", heavy).withColumn(
        "first", ~heavy & complete_or_cold & (place_now < F.col("prefix"))
    )
    plain = F.col("place") < F.col("prefix")
    placed = placed.where(F.col("first") | plain).select("shingle", "doc_id", "n", "heavy", "first")
    # What is listed by the plain order alone serves to meet heavy documents only.
    use = placed.groupBy("shingle").agg(F.sum(F.col("heavy").cast("int")).alias("heavies"))
    kept = placed.join(use, "shingle").where(F.col("first") | (F.col("heavies") > 0)).drop("heavies")
    return materialize(kept, "shared")


def _leaders(shared: DataFrame) -> DataFrame:
    """Every document with the leaders of its buckets, once: ``a`` < ``b``."""
    of = shared.groupBy("shingle").agg(
        F.min(F.when(F.col("heavy"), F.col("doc_id"))).alias("strong"), F.min(F.when(F.col("first"), F.col("doc_id"))).alias("plain")
    )
    led = shared.join(of, "shingle").select(
        "doc_id", F.when(F.col("strong").isNotNull(), F.col("strong")).when(F.col("first"), F.col("plain")).alias("leader")
    )
    led = led.where(F.col("leader").isNotNull() & (F.col("leader") != F.col("doc_id")))
    return led.select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct()


def _near(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose points allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([_loaded(p) for p in batch.column(k).to_pylist()] for k in (2, 3))
            keep = []
            for p, q in zip(left, right):
                groups = min(len(p), len(q))
                p, q = folded(p[None], groups)[0], folded(q[None], groups)[0]
                common = int(np.minimum(p, q).sum(dtype=np.int64))
                keep.append(common >= overlap_needed(int(p.sum(dtype=np.int64)), int(q.sum(dtype=np.int64)), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = points.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p_a"))
    two = points.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("p_b"))
    close = (F.col("n_a") * percent <= F.col("n_b") * 100) & (F.col("n_b") * percent <= F.col("n_a") * 100)
    sized = pairs.join(one.drop("p_a"), "a").join(two.drop("p_b"), "b").where(close).select("a", "b")
    joined = sized.join(one.drop("n_a"), "a").join(two.drop("n_b"), "b").select("a", "b", "p_a", "p_b")
    return joined.mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are linked. ``pairs`` is written; whole texts are shuffled by pair,
    so a document in many pairs burdens no single task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_pylist() + batch.column(3).to_pylist()
            number = {t: k for k, t in enumerate(dict.fromkeys(both))}
            sets = list(shingle_sets(list(number)))
            keep = []
            for t, u in zip(both[: batch.num_rows], both[batch.num_rows :]):
                s, r = sets[number[t]], sets[number[u]]
                common = len(np.intersect1d(s, r, assume_unique=True))
                keep.append(bool(common) and 100 * common >= percent * (len(s) + len(r) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ((few, _),) = broadcast_if_small(pairs)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where(F.col("text").isNotNull())
    one = texts.join(few, F.col("id") == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
    two = texts.join(few, F.col("id") == F.col("b")).select("a", "b", F.col("text").alias("text_b"))
    joined = one.join(two, ["a", "b"]).select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a bigint, b bigint").distinct()


def _across(shared: DataFrame, labels: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that meet in a bucket and whose bound allows a link."""
    found = shared.join(labels, F.col("doc_id") == F.col("id"), "left").select(
        "shingle", "doc_id", "heavy", "first", F.coalesce("component", "doc_id").alias("component")
    )
    member = F.xxhash64("doc_id", "heavy", "first").cast("decimal(38,0)")
    buckets = found.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("docs"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.sum(F.col("heavy").cast("int")).alias("heavies"), F.sum(F.col("first").cast("int")).alias("firsts"),
        F.sum(member).alias("members"), F.min("doc_id").alias("least"),
    ).where("low <> high and (heavies > 0 or firsts > 1)")
    # Shingles of one passage often have the same documents: one bucket stands for all of them.
    buckets = buckets.dropDuplicates(["docs", "members", "least"]).select("shingle", "docs", "heavies", "firsts")
    # Blocks of those listed first have negative numbers, each meets each. Where there are heavy documents, their
    # blocks are numbered from 0 and meet all; the blocks of the others follow and meet those of heavy ones only.
    listed, strong, rest = (F.ceil(F.expr(c) / BLOCK).cast("int") for c in ("firsts", "heavies", "docs - heavies"))
    place = F.xxhash64("doc_id")

    def units(own, low, high, many):
        return F.transform(F.sequence(low, high), lambda k: F.struct(own.cast("int").alias("own"), k.alias("other"), many.alias("large")))

    own_heavy = F.when(F.col("heavy"), F.pmod(place, strong)).otherwise(strong + F.pmod(place, rest))
    last = F.when(F.col("heavy"), strong + rest).otherwise(strong) - 1
    # A row of a large bucket has many pairs, so what tells them apart better is worth its bytes there.
    first = F.when(F.col("first") & (F.col("firsts") > 1), units(-1 - F.pmod(place, listed), -listed, F.lit(-1), F.col("firsts") > LARGE))
    heavy = F.when(F.col("heavies") > 0, units(own_heavy, F.lit(0), last, F.col("docs") > LARGE))
    none = F.array().cast("array<struct<own:int,other:int,large:boolean>>")
    met = F.concat(F.coalesce(first, none), F.coalesce(heavy, none))
    spread = found.join(buckets, "shingle").select("shingle", "doc_id", "component", F.explode(met).alias("unit"))
    spread = spread.select("shingle", "doc_id", "component", "unit.*")
    spread = spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    spread = spread.join(points, "doc_id").select(
        "shingle", "i", "j", "own", "doc_id", "component", "n", "large",
        F.when(F.col("large"), F.col("fine")).otherwise(F.col("point")).alias("point"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        for rows, ends in _whole_buckets(batches):
            found = _pairs(rows, ends, percent)
            while some := list(islice(found, TOLD_AT_ONCE)):
                # Pairs that this task has told before, as far as they fit, are not told again.
                new = [pair for pair in dict.fromkeys(some) if pair not in told]
                if len(told) > TOLD:
                    told.clear()
                told.update(new)
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*new)], ["a", "b"])

    sorted_rows = spread.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows, some thousands at a time, cut between buckets, and where each bucket starts."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < ROWS:
            continue
        rows = pa.Table.from_batches(held)
        starts = _starts(rows)
        last = int(starts[-1])
        if last:
            yield rows.slice(0, last), np.append(starts[:-1], last)
        held = rows.slice(last).combine_chunks().to_batches()
        size = sum(b.num_rows for b in held)
    if size:
        rows = pa.Table.from_batches(held)
        yield rows, np.append(_starts(rows), rows.num_rows)


def _starts(rows: pa.Table) -> np.ndarray:
    changed = np.zeros(rows.num_rows, bool)
    changed[0] = True
    for name in ("shingle", "i", "j"):
        column = rows.column(name).to_numpy()
        changed[1:] |= column[1:] != column[:-1]
    return np.nonzero(changed)[0]


def _pairs(rows: pa.Table, ends: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of several buckets (or pairs of blocks of one, at most ``2 * BLOCK`` rows or so each).

    Buckets that fit one leaf are their own tree: all of a size are paired at once. Larger ones get
    a tree for each number of groups, searched by the documents that have as many, for partners with
    as many or twice as many; sets of more unlike sizes cannot link. Of two blocks, one is searched by the other.
    """
    names = ("own", "i", "j", "doc_id", "component", "n", "large")
    own, i, j, doc, component, size, large = (rows.column(c).to_numpy() for c in names)
    stored = rows.column("point").to_pylist()
    groups = np.array([_groups(x) for x in stored], np.int64)

    def may(q: np.ndarray, t: np.ndarray) -> np.ndarray:
        small, large = np.minimum(size[q], size[t]), np.maximum(size[q], size[t])
        other_block = (i[q] == j[q]) | (own[q] != own[t])
        return (component[q] != component[t]) & other_block & (small * 100 >= large * percent)

    def matrix(at: np.ndarray, width: int) -> np.ndarray:
        return _matrix([stored[k] for k in at.tolist()], width)

    starts, counts = ends[:-1], np.diff(ends)
    together: list[tuple[np.ndarray, np.ndarray]] = []
    for count in range(2, FAN + 1):
        at = starts[counts == count]
        if len(at):
            low, high = np.triu_indices(count, 1)
            q, t = (at[:, None] + low).ravel(), (at[:, None] + high).ravel()
            near = may(q, t)
            together.append((q[near], t[near]))
    if together:
        q, t = (np.concatenate(x) for x in zip(*together))
        a, b = np.minimum(doc[q], doc[t]), np.maximum(doc[q], doc[t])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        once = order[np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(order)]]
        for some_q, some_t in _bounded(matrix, groups, size, q[once], t[once], percent):
            yield from _ordered(doc, some_q, some_t)
    for start, count in zip(starts[counts > FAN].tolist(), counts[counts > FAN].tolist()):
        inside = np.arange(start, start + count)
        if len(np.unique(component[inside])) < 2:
            continue
        if i[start] == j[start]:
            sides = [(inside, inside, 1)]
        else:
            left = own[inside] == i[start]
            sides = [(inside[left], inside[~left], 1), (inside[~left], inside[left], 2)]
        for asking, asked, least in sides:
            for g in np.unique(groups[asking]).tolist():
                queries = asking[groups[asking] == g]
                targets = asked[(groups[asked] == least * g) | (groups[asked] == 2 * g)]
                if not len(targets):
                    continue
                walked = coarse(g) if large[start] else g
                sizes = size.astype(np.int64)
                tree = CountTree(matrix(targets, walked), sizes[targets])
                for q, t in tree.searched(matrix(queries, walked), sizes[queries], percent):
                    q, t = queries[q], targets[t]
                    near = may(q, t)
                    for some_q, some_t in _bounded(matrix, groups, size, q[near], t[near], percent) if large[start] else [(q[near], t[near])]:
                        yield from _ordered(doc, some_q, some_t)


def _bounded(
    matrix: Callable[[np.ndarray, int], np.ndarray], groups: np.ndarray, size: np.ndarray, q: np.ndarray, t: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The given pairs of rows whose points, over as many groups as both have, allow a link."""
    least = np.minimum(groups[q], groups[t])
    for g in np.unique(least).tolist():
        some_q, some_t = q[least == g], t[least == g]
        used, at = np.unique(np.concatenate((some_q, some_t)), return_inverse=True)
        vectors = matrix(used, g)
        shared = bounds(vectors, at[: len(some_q)], vectors, at[len(some_q) :])
        enough = shared >= overlap_needed(size[some_q].astype(np.int64), size[some_t], percent)
        yield some_q[enough], some_t[enough]


def _ordered(doc: np.ndarray, q: np.ndarray, t: np.ndarray) -> Iterator[tuple[int, int]]:
    return zip(np.minimum(doc[q], doc[t]).tolist(), np.maximum(doc[q], doc[t]).tolist())


def _outside(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """In buckets of more than a leaf, every document outside the largest component with three
    documents of that component: near copies that the first leader missed mostly meet one of them."""
    found = shared.join(labels, F.col("doc_id") == F.col("id"), "left").select(
        "shingle", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    parts = found.groupBy("shingle", "component").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("one"), F.max("doc_id").alias("two"),
        F.min_by("doc_id", F.xxhash64("doc_id")).alias("three"),
    )
    largest = parts.groupBy("shingle").agg(
        F.max_by(F.struct("component", F.array("one", "two", "three").alias("leaders")), F.struct("docs", "component")).alias("x"),
        F.sum("docs").alias("all"), F.count(F.lit(1)).alias("components"),
    ).where(F.col("all") > FAN).where("components > 1")
    left = found.join(largest.select("shingle", F.col("x.component").alias("inner"), "x.leaders"), "shingle")
    left = left.where("component <> inner").select("doc_id", F.explode(F.array_distinct("leaders")).alias("leader"))
    return left.select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct()


def _classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Every row's set; documents whose set an earlier one has, with that one; points; and the listed
    shingles of the others, one document for each set."""
    told = materialize(described(docs, percent), "described")
    spoken = told.where(F.col("n") > 0).where(F.col("doc_id").isNotNull())
    same = materialize(
        spoken.select("doc_id", "high", "low").groupBy("high", "low").agg(F.min("doc_id").alias("least")), "same"
    )
    copies = spoken.select("doc_id", "high", "low").join(same, ["high", "low"]).where("doc_id <> least")
    copies = materialize(copies.distinct(), "copies")
    ((known, _),) = broadcast_if_small(copies.select("doc_id", "high", "low"))
    single = spoken.join(known, ["doc_id", "high", "low"], "left_anti")
    return told, copies, spoken.select("doc_id", "n", "point", "fine"), _shared(single, percent)


def class_links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links between documents with different sets, and which documents have the same.

    First ``a`` and ``b``, the smaller id before: one pair for every two linked classes, a class being the
    documents of one set, told by its smallest id. Second ``doc_id`` and ``class_id`` of every row; documents
    without shingles are classes of their own, and so is a null id (with a null class). Documents
    of a class link with each other, and with all of a linked class.

    All pairs that the trees leave are verified, those inside a component too, so the work grows with
    the number of links between different texts. ``linked_components`` needs far fewer pairs.
    """
    docs = docs.select("doc_id", "text")
    told, copies, points, shared = _classes(docs, percent)
    apart = docs.sparkSession.createDataFrame([], "id bigint, component bigint")
    pairs = materialize(_across(shared, apart, points, percent), "pairs")
    links = materialize(_verified(pairs, docs, percent), "links")
    first = copies.select(F.col("doc_id").alias("id"), F.col("high").alias("h"), F.col("low").alias("l"), "least")
    own = (F.col("doc_id") == F.col("id")) & (F.col("high") == F.col("h")) & (F.col("low") == F.col("l"))
    members = told.join(first, own, "left").select("doc_id", F.coalesce("least", "doc_id").alias("class_id"))
    return links, members


def link_counts(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_links``, the number of other documents that each links with, from
    ``class_links``; for tables with unique ids. Links are counted by class and not told one by one."""
    links, members = class_links(docs, percent)
    members = materialize(members, "members")
    sizes = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("size"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes, F.col("b") == F.col("class_id")).groupBy("a").agg(F.sum("size").alias("others"))
    spoken = materialize(sizes.join(linked, F.col("class_id") == F.col("a"), "left").drop("a"), "sizes")
    counted = members.alias("m").join(spoken.alias("s"), F.col("m.class_id") == F.col("s.class_id"), "left")
    n_links = F.coalesce(F.col("s.size") - 1, F.lit(0)) + F.coalesce(F.col("s.others"), F.lit(0))
    return counted.select("m.doc_id", "m.class_id", n_links.cast("bigint").alias("n_links"))


def linked_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row: the smallest id reachable over links.

    Sets link when 100 * common >= ``percent`` * united. Words are what stands between blanks and
    the control characters 9 to 13, A-Z lower-cased; fewer than five are one shingle. A null or
    wordless text has no shingles and stays alone. Rows with the same id are one document that any
    of its texts can link; a null id has a null component. Empty input gives no rows.
    """
    docs = docs.select("doc_id", "text")
    told, copies, points, shared = _classes(docs, percent)
    pairs = materialize(_near(_leaders(shared), points, percent), "pairs")
    links = materialize(_verified(pairs, docs, percent), "links")
    pairs = materialize(_near(_outside(shared, components(links)), points, percent), "pairs")
    links = links.unionByName(materialize(_verified(pairs, docs, percent), "links"))
    pairs = materialize(_across(shared, components(links), points, percent), "pairs")
    more = materialize(_verified(pairs, docs, percent), "links")
    # Copies join their set's first document; an id whose rows have several sets joins them.
    joined = links.unionByName(more).unionByName(copies.select(F.col("least").alias("a"), F.col("doc_id").alias("b")))
    labels = components(joined)
    return told.select("doc_id", "n").join(labels, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component of near copies: the one that gives the component its id.

    An id is one document: rows that repeat the id that stays are kept with it, and so are rows without id.
    """
    found = linked_components(docs, percent)
    others = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    ((gone, _),) = broadcast_if_small(materialize(others, "others"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
