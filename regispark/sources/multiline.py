"""Records with line breaks inside quotes, read by as many tasks as a file has splits.

Whether a line break ends a record depends on all text before it, but only through one bit: does
the line begin inside a quoted field? Each line maps that bit to the next line's, and these maps
compose. A first pass reads every split and reports its map, with the pieces of records that the split's
ends cut off, for either bit. Composing the maps in file order gives each split the bit it begins
with. A second pass cuts whole records; the cut-off pieces, a few per split, are put together apart.

Quotes open a field only at its start, as in the parser; a quote elsewhere is a character like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regispark.session import materialize, ship

#: Longest record that may be cut by the end of a split, in characters.
RECORD_LIMIT = 16 * 1024 * 1024

# Text up to the quote that closes a field, a pair of quotes standing for one; then what may follow it.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^;]*+|[^";][^;]*+|);)*+'
_OPENED = rf'{_FIELDS}"{_QUOTED}\z'
BEGUN_OUTSIDE = rf"^{_OPENED}"
BEGUN_INSIDE = rf'^{_QUOTED}(?:"[^;]*+;{_OPENED}|\z)'

# One whole record of bytes with its line end; none matches where the last quote is not closed.
_CLOSED = rb'(?:"[^"]*+(?:""[^"]*+)*+"[^;\n]*+|[^";\n][^;\n]*+|)'
RECORD = re.compile(rb"(?:" + _CLOSED + rb";)*+" + _CLOSED + rb"(?:\n|\Z)")

BLOCKS = (
    "path string, file string, start bigint, from_outside boolean, from_inside boolean, head string, "
    "closes boolean, head_size bigint, tail_outside string, outside_size bigint, tail_inside string, inside_size bigint"
)


def after_line(line: Column) -> tuple[Column, Column]:
    """Whether the text after a line is inside quotes, if the line begins outside, and if it begins inside."""
    quoted = F.contains(line, F.lit('"'))
    return quoted & line.rlike(BEGUN_OUTSIDE), ~quoted | line.rlike(BEGUN_INSIDE)


def same_splits(spark: SparkSession) -> SparkSession:
    """A session whose scans split files alike at any time, however many executors there are by then."""
    fixed = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        fixed.conf.set(key, spark.conf.get(key))
    given = spark.conf.get("spark.sql.files.minPartitionNum", None)
    fixed.conf.set("spark.sql.files.minPartitionNum", given or str(spark.sparkContext.defaultParallelism))
    return fixed


def read_lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None) -> DataFrame:
    """Raw lines with ``file``, ``path`` and the ``start`` of the split they are read in."""
    reader = same_splits(spark).read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        "value",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def records(
    lines: DataFrame, text: Column, *, file: str, on_error: str = "fail", limit: int = RECORD_LIMIT
) -> DataFrame:
    """``(file, value, whole)``: one row per record of ``lines`` (from ``read_lines``), ``text`` being the cleaned line.

    Line breaks inside a record stay as they are. A quote that is never closed makes the rest of
    the file one record. A record of more than ``limit`` characters that a split's end cuts fails
    the job, or with ``on_error="quarantine"`` gives a row that says so and has ``whole`` false.
    Runs the first pass at once; the rows come in a second one.
    """
    spark = lines.sparkSession
    ship(spark)
    outside, inside = after_line(F.col("text"))
    marked = lines.select("path", "file", "start", text.alias("text")).select(
        "path", "file", "start", outside.alias("from_outside"), inside.alias("from_inside"), "text"
    )
    blocks = materialize(marked.mapInArrow(_reporter(limit), BLOCKS), "blocks")
    blocks = materialize(with_begin(blocks), "begins")
    # Nine bytes for each split, which takes in the order of a hundred megabytes.
    known = blocks.select(F.xxhash64("path", "start").alias("split"), "inside").orderBy("split").toArrow()
    begins = known.column("split").to_numpy(), known.column("inside").to_numpy()
    held = spark.sparkContext.broadcast(begins)
    keyed = marked.withColumn("path", F.xxhash64("path", "start"))
    uncut = keyed.mapInArrow(_cutter(held), "file string, value string").withColumn("whole", F.lit(True))
    named = uncut.unionByName(put_together(blocks, on_error, limit))
    return named.withColumnRenamed("file", file)


def with_begin(blocks: DataFrame) -> DataFrame:
    """Splits with ``inside``: whether each begins inside quotes, from the maps of those before it."""
    constant = F.col("from_outside") == F.col("from_inside")
    swaps = F.when(~constant & F.col("from_outside"), 1).otherwise(0)
    in_order = Window.partitionBy("path").orderBy("start")
    so_far = blocks.withColumn("_swaps", F.sum(swaps).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(constant, F.struct(F.col("from_outside").alias("is"), F.col("_swaps").alias("at")))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    told = so_far.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(earlier)).withColumn(
        "_before", F.coalesce(F.max("_swaps").over(earlier), F.lit(0))
    )
    since = (F.col("_before") - F.coalesce(F.col("_fixed.at"), F.lit(0))) % 2 == 1
    inside = F.coalesce(F.col("_fixed.is"), F.lit(False)) != since
    return told.withColumn("inside", inside).drop("_swaps", "_fixed", "_before")


def put_together(blocks: DataFrame, on_error: str, limit: int) -> DataFrame:
    """Records that the ends of splits cut, from their pieces."""
    inside = F.col("inside")
    head = F.when(inside, F.struct(F.lit(0).alias("kind"), F.col("head").alias("value"), F.col("head_size").alias("size")))
    opens = F.when(inside, F.col("closes") & F.col("from_inside")).otherwise(F.col("from_outside"))
    tail = F.when(
        opens,
        F.struct(
            F.lit(1).alias("kind"),
            F.when(inside, F.col("tail_inside")).otherwise(F.col("tail_outside")).alias("value"),
            F.when(inside, F.col("inside_size")).otherwise(F.col("outside_size")).alias("size"),
        ),
    )
    pieces = blocks.select("path", "file", "start", F.explode(F.array_compact(F.array(head, tail))).alias("piece"))
    in_order = Window.partitionBy("path").orderBy("start", "piece.kind")
    number = F.sum(F.col("piece.kind")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.withColumn("record", number)
    sizes = Window.partitionBy("path", "record")
    placed = placed.withColumn("total", F.sum("piece.size").over(sizes)).withColumn(
        "missing", F.max(F.col("piece.value").isNull()).over(sizes)
    )
    long = F.col("missing") | (F.col("total") > limit)
    kept = F.when(~long, F.struct("start", "piece.kind", "piece.value"))
    joined = placed.withColumn("long", long).groupBy("path", "file", "record").agg(
        F.max("long").alias("long"),
        F.min("start").alias("start"),
        F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda p: p["value"]), "\n").alias("value"),
    )
    told = F.concat(F.lit(f"record of more than {limit} characters in "), "path", F.lit(" from byte "), "start", F.lit(" on"))
    if on_error == "fail":
        told = F.raise_error(told).cast("string")
    return joined.select("file", F.when(F.col("long"), told).otherwise(F.col("value")).alias("value"), (~F.col("long")).alias("whole"))


def states(outside: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """Whether the text after each line is inside quotes, the first line beginning as told."""
    place = np.arange(len(outside))
    fixed = np.maximum.accumulate(np.where(outside == inside, place, -1))
    swaps = np.cumsum(outside & ~inside)
    begin = np.where(fixed >= 0, outside[fixed], first)
    since = swaps - np.where(fixed >= 0, swaps[fixed], 0)
    return begin ^ (since % 2 == 1)


class _Pieces:
    """What a split cuts off, if it begins outside (or inside) quotes."""

    def __init__(self, inside: bool, limit: int):
        self.state, self.limit = inside, limit
        self.head_open = inside
        self.head, self.head_size = None, 0
        self.held: list[str] | None = []
        self.size = 0

    def _hold(self, lines: pa.Array) -> None:
        self.size += int(pa.compute.sum(pa.compute.utf8_length(lines)).as_py() or 0) + len(lines)
        if self.size > self.limit:
            self.held = None
        elif self.held is not None:
            self.held += lines.to_pylist()

    def _joined(self) -> str | None:
        return None if self.held is None else "\n".join(self.held)

    def take(self, outside: np.ndarray, inside: np.ndarray, lines: pa.Array) -> None:
        after = states(outside, inside, self.state)
        ends = np.flatnonzero(~after)
        self.state = bool(after[-1])
        if not len(ends):
            self._hold(lines)
            return
        if self.head_open:
            self._hold(lines.slice(0, int(ends[0]) + 1))
            self.head, self.head_size, self.head_open = self._joined(), self.size, False
        self.held, self.size = [], 0
        if self.state:
            self._hold(lines.slice(int(ends[-1]) + 1))


def _split(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of one split after the other; a task may read several."""
    start = batch.column("start").to_numpy()
    path = batch.column("path").dictionary_encode()
    code = path.indices.to_numpy()
    edges = np.flatnonzero(np.r_[True, (start[1:] != start[:-1]) | (code[1:] != code[:-1]), True])
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield (path[low].as_py(), int(start[low])), batch.slice(low, high - low)


def _bits(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(part.column(c).to_numpy(zero_copy_only=False) for c in ("from_outside", "from_inside"))


def _reporter(limit: int):
    """First pass: one row per split."""

    def row(key: tuple, file: str, pair: tuple[_Pieces, _Pieces]) -> pa.RecordBatch:
        out, in_ = pair
        told = {
            "path": key[0], "file": file, "start": key[1], "from_outside": out.state, "from_inside": in_.state,
            "head": in_._joined() if in_.head_open else in_.head, "closes": not in_.head_open,
            "head_size": in_.size if in_.head_open else in_.head_size,
            "tail_outside": out._joined() if out.state else None, "outside_size": out.size,
            "tail_inside": in_._joined() if in_.state and not in_.head_open else None, "inside_size": in_.size,
        }
        kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
        columns = [part.split() for part in BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([told[n]], kinds[k]) for n, k in columns], [n for n, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, file, pair = None, None, None
        for batch in batches:
            for mine, part in _split(batch) if batch.num_rows else ():
                if mine != key:
                    if key:
                        yield row(key, file, pair)
                    key, file = mine, part.column("file")[0].as_py()
                    pair = _Pieces(False, limit), _Pieces(True, limit if mine[1] else 0)
                for one in pair:
                    one.take(*_bits(part), part.column("text"))
        if key:
            yield row(key, file, pair)

    return run


def _cutter(begins):
    """Second pass: the records that lie within a split."""

    def begins_inside(split: int) -> bool:
        splits, inside = begins.value
        at = int(np.searchsorted(splits, split))
        if at == len(splits) or splits[at] != split:
            raise RuntimeError("files or their splits changed between the two passes")
        return bool(inside[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, skip, held = None, False, False, []
        for batch in batches:
            for mine, part in _split(batch) if batch.num_rows else ():
                if mine != key:
                    key, state, held = mine, begins_inside(mine[0]), []
                    skip = state  # the record that is open here is put together elsewhere
                after = states(*_bits(part), state)
                before = np.r_[state, after[:-1]]
                state = bool(after[-1])
                text, file = part.column("text"), part.column("file")
                alone = pa.array(~before & ~after)
                yield pa.RecordBatch.from_arrays([file.filter(alone), text.filter(alone)], ["file", "value"])
                done = []
                pieces = np.flatnonzero(before | after)
                for at, line, ends in zip(pieces.tolist(), text.take(pa.array(pieces)).to_pylist(), (~after[pieces]).tolist()):
                    if not before[at]:
                        held = []
                    held.append(line)
                    if ends:
                        if not skip:
                            done.append("\n".join(held))
                        held, skip = [], False
                if done:
                    name = file[0].as_py()
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(done)), pa.array(done)], ["file", "value"])

    return run


def records_of(data: bytes) -> list[bytes]:
    """Records of a block that begins with one, without their line ends; a last one may be unclosed."""
    found, at = [], 0
    while at < len(data):
        match = RECORD.match(data, at)
        if match is None:
            found.append(data[at:])
            break
        found.append(match.group().removesuffix(b"\n"))
        at = match.end()
    return found


def closed_length(data: bytes) -> int:
    """Length of the whole records, each with its line end, that a block begins with."""
    at = 0
    while at < len(data):
        match = RECORD.match(data, at)
        if match is None or match.group()[-1:] != b"\n":
            break
        at = match.end()
    return at
