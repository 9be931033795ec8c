"""Prefix trie of conversations, by range minima over sorted longest common prefixes.

Conversations are sorted by their turns (as 128-bit ids). ``lcp[i]`` is the number of turns that place i
shares with the place before, and a sparse table answers minima over any stretch of it. The
members of a prefix are an interval of places: every candidate prefix, a place and a depth,
binary-searches on the table how far to its left and to its right the minimum stays at its depth or
more. No stack is kept, so candidates do not wait for each other.

The sorted order lies in range partitions. Searches that run out of one go on in a table over the
partitions: the least ``lcp`` in each, and at which places it first, and last, falls below each depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import materialize, ship, words
from regispark.operators.joins import broadcast_if_small

#: Bytes of a turn's id.
ID = 16
#: Conversations of a group share the opening of its first one.
GROUP = 20
#: monotonically_increasing_id: partition above, place below.
PART_BITS = 33
FAR = 1 << 40
NOTHING = hashlib.sha256(b"").hexdigest()


def _turns() -> Column:
    """Turns of a conversation in order: by turn (null first), role, then a digest of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    one = F.struct("turn", role.alias("role"), told.alias("told"), F.size(words(text)).alias("words"))
    return F.sort_array(F.collect_list(one))


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of every conversation; rows without ``conv_id`` belong to none."""
    kept = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    return kept.groupBy("conv_id").agg(_turns().alias("turns"))


def shared_openings(own: DataFrame, group: int = GROUP, kinds: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of the first one of their group: h = crc32(conv_id) % ``kinds``,
    the first one's id is conv_id - conv_id % ``group`` (remainder as in SQL, with the sign of the id)."""
    own = materialize(own, "conversations")
    first = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, kinds - 1).alias("opening")
    )
    ((first, _),) = broadcast_if_small(first)
    h = (F.crc32(F.col("conv_id").cast("string")) % kinds).cast("int")
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("first"), "left")
    none = F.slice("turns", 1, 0)
    opening = F.slice(F.coalesce("opening", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def sorted_conversations(convs: DataFrame) -> DataFrame:
    """``part``, ``at``, ``conv_id``, ``ids`` (of all turns, in a row) and ``words`` (of each), sorted by ids and conv_id
    over many parts; written, so that places never change."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["told"]), ""))
    keyed = convs.select(ids.alias("ids"), "conv_id", F.transform("turns", lambda t: t["words"]).alias("words"))
    ordered = keyed.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    placed = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("place", PART_BITS)
    return placed.select(
        part.alias("part"), F.col("place").bitwiseAND((1 << PART_BITS) - 1).alias("at"), "conv_id", "ids", "words"
    )


class Sparse:
    """Minima over stretches of an array, and searches for how far they stay at a value or more."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.size:
            last, reach = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-reach], last[reach:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over low..high, both included."""
        out = np.empty(len(low), self.levels[0].dtype)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            mine = np.flatnonzero(level == k)
            row = self.levels[k]
            out[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last place that the minimum from ``at`` + 1 on stays at ``depth`` or more."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            ahead = at + (1 << k)
            fits = np.flatnonzero(ahead < self.size)
            fits = fits[self.levels[k][at[fits] + 1] >= depth[fits]]
            at[fits] = ahead[fits]
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First place from which on the minimum up to ``at`` stays at ``depth`` or more; place 0 has no value."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            back = at - (1 << k)
            fits = np.flatnonzero(back >= 0)
            fits = fits[self.levels[k][back[fits] + 1] >= depth[fits]]
            at[fits] = back[fits]
        return at


class Sorted:
    """The conversations of one part, in order."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("at")
        self.conv = table["conv_id"].to_numpy().astype(np.int64)
        raw = table["ids"].to_pylist()
        self.length = np.array([len(x) // ID for x in raw], np.int64)
        self.start = np.cumsum(np.r_[0, self.length])
        self.first, self.last = raw[0], raw[-1]
        ids = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2)
        if len(table) and "words" in table.column_names:
            self.words = np.concatenate([np.asarray(w, np.int64) for w in table["words"].to_pylist()])
        self.lcp = np.zeros(len(raw), np.int64)
        open_ = np.arange(1, len(raw))
        depth = 0
        while len(open_):
            open_ = open_[(self.length[open_] > depth) & (self.length[open_ - 1] > depth)]
            mine, before = ids[self.start[open_] + depth], ids[self.start[open_ - 1] + depth]
            open_ = open_[(mine == before).all(axis=1)]
            depth += 1
            self.lcp[open_] = depth


def common_turns(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b)) // ID
    x, y = (np.frombuffer(v[: most * ID], np.uint64).reshape(-1, 2) for v in (a, b))
    other = np.flatnonzero((x != y).any(axis=1))
    return int(other[0]) if len(other) else most


OUTLINE = (
    "part bigint, n bigint, least bigint, longest bigint, fall_depth array<bigint>, fall_at array<bigint>, "
    "fall_longest array<bigint>, rise_depth array<bigint>, rise_at array<bigint>, first binary, last binary"
)


def _outline(part: tuple, table: pa.Table) -> pa.Table:
    """What searches from other parts need to know of this one: where, from either end, ``lcp`` falls below
    each depth, and the longest conversation before that."""
    own = Sorted(table)
    lcp, size = own.lcp, len(own.lcp)
    inner = lcp[1:]
    falls = 1 + np.flatnonzero(inner < np.minimum.accumulate(np.r_[FAR, inner])[:-1])
    back = inner[::-1]
    rises = size - 1 - np.flatnonzero(back < np.minimum.accumulate(np.r_[FAR, back])[:-1])
    longest = np.maximum.accumulate(own.length)
    row = {
        "part": part[0].as_py(), "n": size, "least": int(inner.min()) if size > 1 else FAR, "longest": int(longest[-1]),
        "fall_depth": lcp[falls].tolist(), "fall_at": falls.tolist(), "fall_longest": longest[falls - 1].tolist(),
        "rise_depth": lcp[rises].tolist(), "rise_at": rises.tolist(), "first": own.first, "last": own.last,
    }
    return pa.Table.from_pylist([row], schema=_OUTLINE)


_LONGS = pa.list_(pa.int64())
_OUTLINE = pa.schema(
    [(n, pa.int64()) for n in ("part", "n", "least", "longest")]
    + [(n, _LONGS) for n in ("fall_depth", "fall_at", "fall_longest", "rise_depth", "rise_at")]
    + [("first", pa.binary()), ("last", pa.binary())]
)


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part, last, first = (c.to_pylist() for c in batch.columns)
        shared = [common_turns(a, b) for a, b in zip(last, first)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(shared, pa.int64())], ["part", "shared"])


class Parts:
    """The order of all parts: what each begins at, shares with the one before, and its outline."""

    def __init__(self, outlines: list, shared: dict):
        self.rows = sorted(outlines, key=lambda r: r["part"])
        self.index = {r["part"]: k for k, r in enumerate(self.rows)}
        self.begin = np.cumsum([0, *(r["n"] for r in self.rows)])
        # What place 0 of a part shares with the place before; less than nothing at the very first.
        self.shared = np.array([shared.get(r["part"], -1) for r in self.rows], np.int64)
        self.least = np.minimum(self.shared, [r["least"] for r in self.rows])
        self.longest = np.array([r["longest"] for r in self.rows], np.int64)
        self.sparse = Sparse(self.least)

    def right(self, part: int, depth: int) -> tuple[int, int]:
        """For a prefix that reaches the end of ``part``: its last place in the whole order, and the
        longest member behind ``part``."""
        last = int(self.sparse.right(np.array([part]), np.array([depth]))[0])
        longest = int(self.longest[part + 1 : last + 1].max(initial=0))
        if last + 1 < len(self.rows) and self.shared[last + 1] >= depth:
            row = self.rows[last + 1]
            step = next(k for k, d in enumerate(row["fall_depth"]) if d < depth)
            return int(self.begin[last + 1]) + row["fall_at"][step] - 1, max(longest, row["fall_longest"][step])
        return int(self.begin[last + 1]) - 1, longest

    def left(self, part: int, depth: int) -> int:
        """For a prefix that the first place of ``part`` shares with the place before: its first place."""
        first = int(self.sparse.left(np.array([part - 1]), np.array([depth]))[0])
        # Parts first + 1 to part - 1 are wholly inside; of part ``first`` the end is.
        row = self.rows[first]
        for d, at in zip(row["rise_depth"], row["rise_at"]):
            if d < depth:
                return int(self.begin[first]) + at
        return int(self.begin[first])


PIECES = (
    "depth bigint, begins bigint, part bigint, crossing boolean, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, parent_begins bigint, parent_conv_id bigint, ends binary, ends_sha256 string"
)
_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("depth", "begins", "part")] + [("crossing", pa.bool_())]
    + [(n, pa.int64()) for n in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_begins", "parent_conv_id")]
    + [("ends", pa.binary()), ("ends_sha256", pa.string())]
)


def _pieces(parts):
    """Every node's piece in a part: whole nodes, and what the part adds to those that cross its ends."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        whole: Parts = parts.value
        part = whole.index[key[0].as_py()]
        own, begin = Sorted(table), int(whole.begin[part])
        size = len(own.conv)
        shared = int(whole.shared[part])
        lcp = own.lcp.copy()
        lcp[0] = -1  # the first place tells all its prefixes, also those that began before
        sparse, least_conv = Sparse(own.lcp), Sparse(own.conv)

        count = own.length - lcp
        row = np.repeat(np.arange(size), count)
        end = np.cumsum(count)  # candidates of a place end here
        depth = np.arange(end[-1]) - np.repeat(end - count, count) + lcp[row] + 1
        left, right = sparse.left(row, depth), sparse.right(row, depth)
        before = (row == 0) & (depth <= shared)
        ahead = int(whole.shared[part + 1]) if part + 1 < len(whole.rows) else -1
        behind = (right == size - 1) & (depth <= ahead)

        begins, last = begin + left, begin + right
        longest = -Sparse(-own.length).least(left, right)
        for at in np.flatnonzero(before):
            begins[at] = whole.left(part, int(depth[at]))
        for at in np.flatnonzero(behind):
            last[at], more = whole.right(part, int(depth[at]))
            longest[at] = max(longest[at], more)

        here = ~before
        members = last - begins + 1
        tail = np.where(depth > 0, own.start[row] + depth - 1, 0)
        in_tail = own.words[tail] if len(own.words) else np.zeros(len(row), np.int64)
        saved = np.where(here & (depth > 0), (members - 1) * in_tail, 0)
        leaf = here & (longest == depth)
        upto = end[right]  # the nodes below are the candidates from here to there that begin here
        own_place = np.arange(len(row))

        def below(values: np.ndarray) -> np.ndarray:
            sums = np.cumsum(np.r_[0, values])
            return sums[upto] - sums[own_place]

        starts = np.flatnonzero(here)
        span = len(row) + 1
        coded = np.sort(depth[starts] * span + starts)
        children = np.searchsorted(coded, (depth + 1) * span + upto) - np.searchsorted(coded, (depth + 1) * span + own_place)

        # The parent: one turn less, searched by itself.
        up = np.maximum(depth - 1, 0)
        parent_left, parent_right = sparse.left(row, up), sparse.right(row, up)
        parent_begins = begin + parent_left
        parent_out = (parent_left == 0) & (up <= shared)
        for at in np.flatnonzero(parent_out):
            parent_begins[at] = -1
        for d in np.unique(up[parent_out]):
            parent_begins[parent_out & (up == d)] = whole.left(part, int(d))
        parent_cross = parent_out | ((parent_right == size - 1) & (up <= ahead))
        parent_conv = least_conv.least(parent_left, parent_right)

        # Members that end at a node stand at its first places.
        same = np.r_[False, (own.lcp[1:] == own.length[1:]) & (own.length[1:] == own.length[:-1])]
        edges = np.r_[np.flatnonzero(~same), size]
        stop = edges[np.searchsorted(edges, row, side="right")]
        ending = depth == own.length[row]
        crossing = before | behind
        text = [b""] * len(row)
        told = np.full(len(row), NOTHING, object)
        for at in np.flatnonzero(ending):
            joined = ",".join(map(str, own.conv[row[at] : stop[at]].tolist())).encode()
            if crossing[at]:
                text[at] = joined
            else:
                told[at] = hashlib.sha256(joined).hexdigest()

        top = depth == 0
        columns = [
            depth, begins, np.full(len(row), part), crossing, least_conv.least(left, right), right - left + 1, children,
            below(leaf), below(saved), pa.array(parent_begins, mask=top),
            pa.array(parent_conv, mask=top | parent_cross), pa.array(text, pa.binary()), pa.array(told, pa.string()),
        ]
        return pa.Table.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, _PIECES.types)], schema=_PIECES)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the pieces of each node, which come in order, one piece held at a time."""
    key, digest, any_ = None, None, False
    for batch in batches:
        done = []
        for depth, begins, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, begins) != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest, any_ = (depth, begins), hashlib.sha256(), False
            if ends:
                digest.update(b"," * any_ + ends)
                any_ = True
        yield _told(done)
    if key:
        yield _told([(*key, digest.hexdigest())])


def _told(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * 3
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["depth", "begins", "ends_sha256"])


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``convs`` (``conv_id`` once each, ``turns`` as from ``conversations``): ``conv_id`` (the least
    member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of
    the subtree, itself included), ``saved_tokens`` and ``ends_sha256``.

    No conversations, no nodes. Null roles and texts count as empty. A conversation without turns ends
    at the root. A conversation's ids and word counts, 20 bytes a turn, are held together; its texts are not.
    """
    spark = convs.sparkSession
    ship(spark)
    placed = sorted_conversations(convs)
    outlines = materialize(
        placed.select("part", "at", "conv_id", "ids").groupBy("part").applyInArrow(_outline, OUTLINE), "outlines"
    )
    # A few numbers of each part.
    held = outlines.drop("first", "last").collect()
    if not held:
        return spark.createDataFrame([], PIECES).select(*COLUMNS)
    order = sorted(r["part"] for r in held)
    links = spark.createDataFrame(list(zip(order, order[1:])) or [(-1, -1)], "before bigint, part bigint")
    ends = links.join(outlines.select(F.col("part").alias("before"), "last"), "before").join(
        outlines.select("part", "first"), "part"
    )
    shared = ends.select("part", "last", "first").mapInArrow(_boundaries, "part bigint, shared bigint").collect()
    parts = spark.sparkContext.broadcast(Parts(held, {r["part"]: r["shared"] for r in shared}))
    pieces = materialize(placed.groupBy("part").applyInArrow(_pieces(parts), PIECES), "pieces")

    across = pieces.where("crossing")
    digests = across.where(F.octet_length("ends") > 0).repartition("depth", "begins")
    digests = digests.sortWithinPartitions("depth", "begins", "part").select("depth", "begins", "ends")
    digests = digests.mapInArrow(_hashed, "depth bigint, begins bigint, ends_sha256 string")
    summed = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = across.groupBy("depth", "begins").agg(
        F.min("conv_id").alias("conv_id"), *summed, F.min("parent_begins").alias("parent_begins"),
        F.min("parent_conv_id").alias("parent_conv_id"),
    )
    merged = materialize(
        merged.join(digests, ["depth", "begins"], "left").withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
        ),
        "merged",
    )
    nodes = pieces.where(~F.col("crossing")).select(*merged.columns).unionByName(merged)
    ((above, _),) = broadcast_if_small(
        merged.select(
            (F.col("depth") + 1).alias("depth"), F.col("begins").alias("parent_begins"), F.col("conv_id").alias("_above")
        )
    )
    named = nodes.join(above, ["depth", "parent_begins"], "left")
    return named.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*COLUMNS)
