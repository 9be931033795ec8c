"""Periodic runs of words, found with a grammar by recompression.

Words of many documents become one sequence of numbers, each document closed by a number of its own.
Recompression rewrites it in rounds: every block of one symbol becomes a symbol for (symbol, length),
then every pair of a left and a right symbol becomes one symbol, the sides dealt by a hash. Equal
stretches are rewritten alike but for their ends, so the longest common extension (LCE) of two
places is read off the rounds: up while both places open a symbol and the symbols are equal, down
into the first two that differ.

A run of period q is at least ``TIMES`` periods long, so on a grid of every q-th place it holds
``TIMES`` places in a row, all of one word. Such candidates, n / q places for each q, get exact
extensions to both sides from grammars of the sequence and of its reverse.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import ship, small_batches

#: Least length of a run: this many periods, and this many words.
TIMES = 4
LEAST = 6
#: Words of documents that share a grammar, and extensions that are read off it at once.
WORDS = 250_000
AT_ONCE = 200_000
#: A grammar is not rewritten below this many symbols; what is left is compared symbol by symbol.
FEW = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """Rounds of recompression of a sequence of numbers, whose last number occurs once."""

    def __init__(self, symbols: np.ndarray):
        #: Symbols of each round, their lengths in numbers, and how a round came from the one before:
        #: first symbol below of each, and the symbol above each (-1 if it does not open one).
        self.symbols, self.lengths = [symbols.astype(np.int64)], [np.ones(len(symbols), np.int64)]
        self.first: list[np.ndarray] = []
        self.above: list[np.ndarray] = []
        self.blocks: list[bool] = []
        names = int(symbols.max()) + 1
        stuck = 0
        while len(self.symbols[-1]) > FEW and stuck < 8:
            before = len(self.symbols[-1])
            names = self._blocks(names)
            names = self._pairs(names, len(self.first))
            stuck = stuck + 1 if len(self.symbols[-1]) == before else 0

    def _push(self, first: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        above = np.full(len(self.symbols[-1]), -1, np.int64)
        above[first] = np.arange(len(first))
        self.lengths.append(np.add.reduceat(self.lengths[-1], first))
        self.first.append(first)
        self.above.append(above)
        self.blocks.append(blocks)
        self.symbols.append(symbols)

    def _blocks(self, names: int) -> int:
        low = self.symbols[-1]
        first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        if len(first) == len(low):
            return names
        count = np.diff(np.r_[first, len(low)])
        symbols = low[first]
        many = np.flatnonzero(count > 1)
        _, name = np.unique(symbols[many] * (len(low) + 1) + count[many], return_inverse=True)
        symbols = symbols.copy()
        symbols[many] = names + name
        self._push(first, symbols, True)
        return names + int(name.max()) + 1

    def _pairs(self, names: int, round_: int) -> int:
        low = self.symbols[-1]
        mixed = (low.astype(np.uint64) + np.uint64(round_ * 7919 + 1)) * _MIX
        mixed = (mixed ^ mixed >> np.uint64(29)) * _MIX
        side = (mixed >> np.uint64(40)) & np.uint64(1) == 1
        paired = np.flatnonzero(~side[:-1] & side[1:])
        if not len(paired):
            return names
        taken = np.zeros(len(low), bool)
        taken[paired + 1] = True
        first = np.flatnonzero(~taken)
        _, name = np.unique(low[paired] * names + low[paired + 1], return_inverse=True)
        symbols = low.copy()
        symbols[paired] = names + name
        self._push(first, symbols[first], False)
        return names + int(name.max()) + 1

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of places ``a`` and ``b``, pair by pair; no pair is of one place."""
        out = np.zeros(len(a), np.int64)
        for at in range(0, len(a), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            out[part] = self._extended(a[part].astype(np.int64), b[part].astype(np.int64))
        return out

    def _extended(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        # Where the two symbols differ, and the round they differ in: (queries, a, b) by round.
        differ: list[list] = [[] for _ in self.symbols]
        live = np.arange(len(a))
        for k, symbols in enumerate(self.symbols):
            same = symbols[a] == symbols[b]
            self._settle(differ, k, live[~same], a[~same], b[~same])
            live, a, b = live[same], a[same], b[same]
            if not len(live):
                break
            if k == len(self.first):
                while len(live):
                    total[live] += self.lengths[k][a]
                    a, b = a + 1, b + 1
                    same = symbols[a] == symbols[b]
                    self._settle(differ, k, live[~same], a[~same], b[~same])
                    live, a, b = live[same], a[same], b[same]
                break
            above = self.above[k]
            inside = np.flatnonzero((above[a] < 0) | (above[b] < 0))
            if len(inside):
                x, y = a[inside], b[inside]
                if self.blocks[k]:
                    left = np.searchsorted(self.first[k], x, side="right"), np.searchsorted(self.first[k], y, side="right")
                    stops = np.r_[self.first[k], len(symbols)]
                    rest_x, rest_y = stops[left[0]] - x, stops[left[1]] - y
                    step = np.minimum(rest_x, rest_y)
                else:
                    step = np.ones(len(inside), np.int64)
                total[live[inside]] += step * self.lengths[k][x]
                a[inside], b[inside] = x + step, y + step
                other = np.zeros(len(a), bool)
                other[inside] = symbols[a[inside]] != symbols[b[inside]]
                self._settle(differ, k, live[other], a[other], b[other])
                live, a, b = live[~other], a[~other], b[~other]
            a, b = above[a], above[b]
        self._descend(differ, total)
        return total

    @staticmethod
    def _settle(differ: list, k: int, who: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        if len(who):
            differ[k].append((who, a, b))

    def _descend(self, differ: list, total: np.ndarray) -> None:
        for k in range(len(self.symbols) - 1, 0, -1):
            if not differ[k]:
                continue
            who, a, b = (np.concatenate(x) for x in zip(*differ[k]))
            low, lengths, first = self.symbols[k - 1], self.lengths[k - 1], self.first[k - 1]
            stops = np.r_[first, len(low)]
            x, y = first[a], first[b]
            same = np.flatnonzero(low[x] == low[y])
            # Two symbols that differ share at most what the shorter block holds, or one side of a pair.
            step = np.minimum(stops[a[same] + 1] - x[same], stops[b[same] + 1] - y[same]) if self.blocks[k - 1] else 1
            total[who[same]] += step * lengths[x[same]]
            x[same] += step
            y[same] += step
            differ[k - 1].append((who, x, y))


def runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal periodic runs of documents that stand one after the other, longest documents first.

    ``words`` holds numbers from 0; each document is closed by a number that occurs once, and ``ends``
    has the places of these. Returns rows (start, end, period), sorted: every stretch with smallest
    period q of at least ``TIMES`` * q and ``LEAST`` words that cannot be longer.
    """
    sizes = np.diff(np.r_[-1, ends]) - 1
    found: set[tuple[int, int, int]] = set()
    cover_end, cover_q = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    forward = backward = None
    block = [1, 1]
    longest = int(sizes.max(initial=0)) // TIMES
    while block[0] <= longest:
        starts, periods = [], []
        for q in range(block[0], min(block[1], longest) + 1):
            # Documents that can hold such a run are a prefix.
            count = int(np.searchsorted(-sizes, -max(TIMES * q, LEAST), side="right"))
            grid = words[: ends[count - 1] + 1 : q] if count else words[:0]
            equal = grid[1:] == grid[:-1]
            good = equal[: len(equal) - TIMES + 2].copy()
            for j in range(1, TIMES - 1):
                good &= equal[j : len(equal) - TIMES + 2 + j]
            at = np.flatnonzero(good) * q
            for off in {q // 2, q // 3, q - 1} - {0}:
                at = at[words[at + off] == words[at + off + q]]
            at = at[(at + (TIMES - 1) * q >= cover_end[at]) | (q % cover_q[at] != 0)]
            starts.append(at)
            periods.append(np.full(len(at), q, np.int64))
        at, q = np.concatenate(starts), np.concatenate(periods)
        if len(at):
            if forward is None:
                forward, backward = Grammar(words), Grammar(np.r_[words[::-1], words.max() + 1])
            end = at + q + forward.extensions(at, at + q)
            # Backward from the places before: their mirror images, the end of the reverse being one more number.
            start = at - backward.extensions(len(words) - at, len(words) - at - q)
            long = end - start >= np.maximum(TIMES * q, LEAST)
            for run in zip(start[long].tolist(), end[long].tolist(), q[long].tolist()):
                if run not in found:
                    found.add(run)
                    s, e, p = run
                    if e - s >= 2 * TIMES * p:
                        longer = np.flatnonzero(cover_end[s:e] < e) + s
                        cover_end[longer], cover_q[longer] = e, p
        block = [block[1] + 1, 2 * block[1] + 1]
    least: dict[tuple[int, int], int] = {}
    for s, e, q in found:
        least[s, e] = min(q, least.get((s, e), q))
    return np.array(sorted((s, e, q) for (s, e), q in least.items()), np.int64).reshape(-1, 3)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of documents as numbers, each document closed by a number of its own; and where it closes."""
    known: dict[bytes, int] = {}
    parts = []
    for words in texts:
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    close = len(known) + np.arange(len(parts))
    return np.concatenate([np.r_[p, c] for p, c in zip(parts, close)]), ends


RUNS = "id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed binary"
_RUNS = pa.schema(
    [("id", pa.int64()), ("n_words", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("starts", "lengths", "periods")]
    + [("collapsed", pa.binary())]
)


def _collapsed(words: list[bytes], runs_: list[tuple[int, int, int]]) -> bytes:
    if not runs_:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, end, period in runs_:
        keep[start + period : end] = False
    return b" ".join(words[k] for k in np.flatnonzero(keep).tolist())


def told(keys: list, texts: list[list[bytes]]) -> Iterator[tuple]:
    """``(key, words, runs)`` of documents, their runs by place in the document."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    words, ends = numbered([texts[k] for k in order])
    begins = np.r_[0, ends[:-1] + 1]
    found = runs(words, ends)
    whose = np.searchsorted(ends, found[:, 0])
    mine: dict[int, list] = {}
    for k, (start, end, period) in zip(whose.tolist(), found.tolist()):
        mine.setdefault(k, []).append((start - int(begins[k]), end - int(begins[k]), period))
    for place, k in enumerate(order):
        yield keys[k], texts[k], mine.get(place, [])


def _batches(batches: Iterator[pa.RecordBatch], made) -> Iterator[pa.RecordBatch]:
    """Documents gathered until their words fill a grammar, and what is made of each lot."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            # bytes.split cuts at exactly the blank and the control characters 9 to 13
            words = text.as_py().split() if text.is_valid else []
            keys.append(key)
            texts.append(words)
            held += len(words) + 1
            if held >= WORDS:
                yield made(told(keys, texts))
                keys, texts, held = [], [], 0
    if keys:
        yield made(told(keys, texts))


def _mapped(docs: DataFrame, id: str, text: str, made, schema: str) -> DataFrame:
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(lambda batches: _batches(batches, made), schema)


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of every row's text, and the text without their repeats.

    Returns ``id``, ``n_words``, ``starts`` (word numbers), ``lengths`` and ``periods`` (in words) by start, then
    period, and ``collapsed`` (UTF-8): the words that no run contains after its first period, joined by
    one blank. A null text has no words; a text without runs keeps all its words. Rows with null or
    repeated ids each get their own; other columns are not read. One pass, without a shuffle.
    """

    def made(rows: Iterator[tuple]) -> pa.RecordBatch:
        out = [
            (key, len(words), [s for s, _, _ in found], [e - s for s, e, _ in found], [q for _, _, q in found],
             _collapsed(words, found))
            for key, words, found in rows
        ]
        return _record(out, _RUNS)

    return _mapped(docs, id, text, made, RUNS)


DIGESTS = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
_DIGESTS = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def _digest(row: tuple) -> tuple:
    key, words, found = row
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()
    longest = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    best = (None,) * 4
    if longest:
        s, e, q = longest
        best = (s, e - s, q, 1000 * (e - s) // q)
    collapsed = _collapsed(words, found)
    return key, len(found), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(collapsed).hexdigest()


def run_digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``periodic_runs`` as one short row per document: ``doc_id``, ``n_runs``, ``start``, ``length``, ``period`` and
    ``exponent_milli`` of the longest run (ties: smallest start, then period; nulls without a run), and SHA-256
    of the list of runs and of the collapsed text."""
    return _mapped(docs, id, text, lambda rows: _record([_digest(r) for r in rows], _DIGESTS), DIGESTS)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
