"""Byte-level BPE by segment trees: ranks in, ids out, and back.

A piece's bytes are the leaves. A leaf holds the rank of the pair that starts there (its token and
the next live one) together with its place, so the smallest value at the root is the leftmost pair
of least rank. A merge changes three leaves, those of the pair and of its live left neighbour, and
the nodes above them: O(n log n) for a piece of n bytes, however long it is. Short pieces run
many at a time, one merge of each per step; long ones run alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import ship, small_batches
from regispark.llm.units import CACHED, UnitCache, text_of

#: Longest piece, in bytes, that runs together with others.
TOGETHER = 64
#: Pieces that run together, which bounds the trees' memory.
AT_ONCE = 8192
NONE = np.iinfo(np.int64).max
PLACE_BITS = 32


class Ranks:
    """A vocabulary of byte strings by rank; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.codes = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[c] for c in self.codes.tolist()], dtype=np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge."""
        if not len(self.codes):
            return np.full(len(left), NONE)
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.merged[at], NONE)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def _keys(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.where(rank == NONE, NONE, rank << PLACE_BITS | place)


def merge_together(ranks: Ranks, pieces: Sequence[bytes]) -> list[bytes]:
    """Ids of short pieces, as little-endian 32-bit bytes; one merge of every piece per step."""
    count, longest = len(pieces), max(map(len, pieces))
    size = 1 << max(1, (longest - 1).bit_length())
    lengths = np.array([len(p) for p in pieces])
    place = np.arange(size)
    inside = place < lengths[:, None]
    token = np.zeros((count, size + 1), dtype=np.int64)
    token[:, :size][inside] = ranks.single[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.minimum(place + 1, lengths[:, None])  # a piece's length marks its end
    after = np.where(after == lengths[:, None], size, after)
    before = np.tile(np.arange(-1, size), (count, 1))
    live = inside.copy()

    tree = np.full((count, 2 * size), NONE)
    paired = inside & (after < size)
    row, col = np.nonzero(paired)
    tree[row, size + col] = _keys(ranks.pair_ranks(token[row, col], token[row, col + 1]), col)
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    rows = np.nonzero(tree[:, 1] < NONE)[0]
    while len(rows):
        best = tree[rows, 1]
        at, rank = best & ((1 << PLACE_BITS) - 1), best >> PLACE_BITS
        gone = after[rows, at]
        then = after[rows, gone]
        left = before[rows, at]
        token[rows, at] = rank
        after[rows, at] = then
        before[rows, then] = at
        live[rows, gone] = False
        tree[rows, size + gone] = NONE
        new = _keys(ranks.pair_ranks(rank, token[rows, then]), at)
        tree[rows, size + at] = np.where(then < size, new, NONE)
        has = left >= 0
        some, at_left = rows[has], left[has]
        tree[some, size + at_left] = _keys(ranks.pair_ranks(token[some, at_left], rank[has]), at_left)
        for changed, of in ((gone, rows), (at, rows), (at_left, some)):
            node = (size + changed) >> 1
            while len(of) and node[0]:
                tree[of, node] = np.minimum(tree[of, 2 * node], tree[of, 2 * node + 1])
                node = node >> 1
        rows = rows[tree[rows, 1] < NONE]

    flat = token[:, :size][live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(1)) * 4
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def merge_alone(ranks: Ranks, piece: bytes) -> bytes:
    """Ids of one piece of any length."""
    token = ranks.single[np.frombuffer(piece, np.uint8)].tolist()
    count = len(token)
    size = 1 << max(1, (count - 1).bit_length())
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    live = [True] * count
    lookup, none, low = ranks.pairs.get, int(NONE), (1 << PLACE_BITS) - 1

    def key(at: int, then: int) -> int:
        rank = lookup(token[at] << 32 | token[then])
        return none if rank is None else rank << PLACE_BITS | at

    tree = [none] * (2 * size)
    for at in range(count - 1):
        tree[size + at] = key(at, at + 1)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, value: int) -> None:
        node = size + at
        tree[node] = value
        node >>= 1
        while node:
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
            node >>= 1

    while tree[1] != none:
        at, rank = tree[1] & low, tree[1] >> PLACE_BITS
        gone = after[at]
        then, left = after[gone], before[at]
        token[at], after[at], live[gone] = rank, then, False
        put(gone, none)
        if then < count:
            before[then] = at
            put(at, key(at, then))
        else:
            put(at, none)
        if left >= 0:
            put(left, key(left, at))
    return np.array([t for t, alive in zip(token, live) if alive], dtype="<u4").tobytes()


class Encoder:
    """Texts to ids: the pattern's matches, each looked up whole, else merged by segment tree."""

    def __init__(self, ranks: Ranks, pattern: str, limit: int = CACHED):
        import regex

        self.ranks, self.matches, self.limit = ranks, regex.compile(pattern).findall, limit
        self.pieces: dict[str, bytes] = {}
        self.cache = UnitCache(self._units, self._odd, limit)

    def _learn(self, pieces: set[str]) -> None:
        pieces = pieces.difference(self.pieces)
        merge = []
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.ranks.get(raw)
            if rank is not None:
                self.pieces[piece] = rank.to_bytes(4, "little")
            elif len(raw) > TOGETHER:
                self.pieces[piece] = merge_alone(self.ranks, raw)
            else:
                merge.append((len(raw), piece, raw))
        merge.sort(key=lambda x: x[0])
        for start in range(0, len(merge), AT_ONCE):
            some = merge[start : start + AT_ONCE]
            ids = merge_together(self.ranks, [raw for _, _, raw in some])
            self.pieces.update((piece, i) for (_, piece, _), i in zip(some, ids))

    def _units(self, units: Sequence[str]) -> list[bytes]:
        return self._cut([*map(text_of, units)])

    def _cut(self, units: Sequence[str]) -> list[bytes]:
        if len(self.pieces) > self.limit:
            self.pieces.clear()
        cut = [*map(self.matches, units)]
        self._learn({piece for pieces in cut for piece in pieces})
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cut]

    def _odd(self, text: str) -> bytes:
        return self._cut([text])[0]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit bytes."""
        return self.cache.encode(texts)


def decode(ranks: Ranks, ids: bytes) -> bytes:
    """The bytes that ids stand for."""
    return b"".join(map(ranks.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(load_ranks(path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``ids`` (binary, little-endian 32-bit ids).

    A null text counts as empty and has no ids; a null id stays null; repeated rows stay. Reads
    those two columns only. One pass without a shuffle. ``ranks_path`` must be readable on every
    executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return _mapped(docs, id, text, run, f"id {kind}, ids binary")


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The texts of the rows of ``encode``: ``id`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for batch in batches:
            texts = [decode(ranks, ids).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema["id"].dataType.simpleString()
    return _mapped(encoded, "id", "ids", run, f"id {kind}, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of ids and of what they decode to: ``id``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``. Cases as in ``encode``; ids and texts never leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            columns = [
                batch.column(0),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(decode(encoder.ranks, i)).hexdigest() for i in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return _mapped(docs, id, text, run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _mapped(df: DataFrame, first: str, second: str, run, schema: str) -> DataFrame:
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.select(F.col(first), F.col(second)).mapInArrow(run, schema)
