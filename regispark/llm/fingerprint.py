"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every i, sum of c_j * B^j for j < i, modulo a prime, for two
primes. A span's hash is a difference of two entries; brought to a common power of B, it does not
depend on where the span stands, so any two spans compare in constant time, and the longest common
extension of two places is found by binary search.

A fingerprint is made of the hashes of all spans of ``SPAN`` code points: they are dealt over
``LANES`` lanes, and each lane keeps the smallest. The part of lanes in which two texts agree
estimates the Jaccard likeness of their span sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import materialize, ship, small_batches

PRIMES = (2147483647, 2147483629)
BASE = 1000003
#: Code points of a span; shorter texts are one span.
SPAN = 16
#: Lanes of a fingerprint, each 16 bits or four hexadecimal digits.
LANES = 64
EMPTY = 0xFFFF

_powers = {p: np.ones(1, np.uint64) for p in PRIMES}
_inverse = {p: np.ones(1, np.uint64) for p in PRIMES}


def _grown(powers: np.ndarray, step: int, prime: int, count: int) -> np.ndarray:
    while len(powers) < count:
        last = np.uint64(pow(step, len(powers), prime))
        powers = np.concatenate((powers, powers * last % np.uint64(prime)))
    return powers


def powers_of_base(prime: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0 to B^(count - 1), and their inverses."""
    if len(_powers[prime]) < count:
        _powers[prime] = _grown(_powers[prime], BASE, prime, count)
        _inverse[prime] = _grown(_inverse[prime], pow(BASE, -1, prime), prime, count)
    return _powers[prime], _inverse[prime]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class PrefixHashes:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        points = code_points(text)
        self.length = len(points)
        self.prefix = []
        for prime in PRIMES:
            power, _ = powers_of_base(prime, self.length + 1)
            terms = (points + np.uint64(1)) * power[: self.length] % np.uint64(prime)
            sums = np.zeros(self.length + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            sums %= np.uint64(prime)
            self.prefix.append(sums)

    def spans(self, size: int) -> np.ndarray:
        """64-bit hash of every span of ``size`` code points, in order."""
        count = self.length - size + 1
        out = np.zeros(max(count, 0), np.uint64)
        if count > 0:
            for prime, sums in zip(PRIMES, self.prefix):
                p = np.uint64(prime)
                _, back = powers_of_base(prime, self.length + 1)
                span = (sums[size:] + p - sums[:count]) * back[:count]
                out = out << np.uint64(31) | span % p
        return out

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of one span; equal for equal spans, wherever they stand."""
        found = []
        for prime, sums in zip(PRIMES, self.prefix):
            _, back = powers_of_base(prime, self.length + 1)
            found.append((int(sums[end]) - int(sums[start])) % prime * int(back[start]) % prime)
        return (end - start, *found)


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """Length of the longest common extension of place ``i`` of one text and ``j`` of another."""
    low, high = 0, min(a.length - i, b.length - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def lanes(hashes: PrefixHashes) -> np.ndarray:
    """Smallest mixed span hash of each lane."""
    size = min(SPAN, hashes.length)
    kept = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    if size:
        mixed = np.minimum(_mixed(hashes.spans(size)), np.iinfo(np.uint64).max - np.uint64(1))
        np.minimum.at(kept, (mixed & np.uint64(LANES - 1)).astype(np.intp), mixed)
    # The smallest hash of each lane stands for it; its middle bits, below EMPTY, are what is written.
    short = (kept >> np.uint64(16)) % np.uint64(EMPTY)
    return np.where(kept == np.iinfo(np.uint64).max, np.uint64(EMPTY), short).astype(np.uint16)


def written(kept: np.ndarray) -> str:
    return kept.astype(">u2").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Part of the lanes used by either text in which both agree; 1 for two empty texts."""
    used = (a != EMPTY) | (b != EMPTY)
    return float((a == b)[used].mean()) if used.any() else 1.0


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_chars`` (code points) and ``fingerprint`` of every row; a null text is empty.
    Equal texts get equal fingerprints. One pass without a shuffle; repeated rows stay."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [PrefixHashes(t or "") for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([h.length for h in made], pa.int64()),
                pa.array([written(lanes(h)) for h in made], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "fingerprint"])

    kind = docs.select(id).schema[0].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"id {kind}, n_chars bigint, fingerprint string")


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter of code points (rounded
    down) gives way to the first as many of the next document by ascending id (after the last: the first).

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` and ``common_prefix`` (code points that text and edited text
    share from the start, by binary search over prefix hashes) of every row. A null text is empty. Rows
    without id come first; rows with the same id go by a hash of their text, then by text. A lone
    document is its own next one.

    Texts are shuffled once, into sorted ranges, where the next document is the next row. Only
    the last document of each range waits for the first one of the next range.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    told = materialize(ordered.mapInArrow(_in_range, f"{RESULT}, part int, first string, last string"), "fingerprints")
    lasts, firsts = told.where("last is not null"), told.where("first is not null")
    # One number per range.
    parts = sorted(r[0] for r in firsts.select("part").collect())
    links = list(zip(parts, parts[1:] + parts[:1]))
    ends = lasts.select("doc_id", "part", F.col("last").alias("text")).join(
        spark.createDataFrame(links, "part int, next_part int"), "part"
    )
    ends = ends.join(firsts.select(F.col("part").alias("next_part"), F.col("first").alias("next")), "next_part")
    made = told.where("last is null and first is null").select(*COLUMNS)
    return made.unionByName(ends.select("doc_id", "text", "next").mapInArrow(_at_ends, RESULT))


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix bigint"
)
COLUMNS = [part.split()[0] for part in RESULT.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]


def _compared(key: int, text: str, own: PrefixHashes, mine: np.ndarray, next_text: str, next_lanes: np.ndarray) -> tuple:
    quarter = len(text) // 4
    edited = text[: len(text) - quarter] + next_text[:quarter]
    other = PrefixHashes(edited)
    theirs = lanes(other)
    return (
        key, own.length, hashlib.sha256(edited.encode()).hexdigest(), written(mine), written(theirs),
        likeness(mine, theirs), likeness(mine, next_lanes), common_extension(own, 0, other, 0),
    )


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range: every document but the last compared, and the first and last text as they are."""
    schema = pa.schema([*zip(COLUMNS, TYPES), ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])
    part = TaskContext.get().partitionId()
    blank = (None,) * (len(COLUMNS) - 1)
    before = None
    for batch in batches:
        out = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = PrefixHashes(text)
            mine = lanes(own)
            if before:
                out.append((*_compared(*before, text, mine), part, None, None))
            else:
                out.append((key, *blank, part, text, None))
            before = (key, text, own, mine)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    if before:
        row = (before[0], *blank, part, None, before[1])
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text, following in zip(*(c.to_pylist() for c in batch.columns)):
            own = PrefixHashes(text)
            row = _compared(key, text, own, lanes(own), following, lanes(PrefixHashes(following)))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES)], COLUMNS)
