"""Token files: flat unsigned ids with 64-bit document offsets, written and read by many tasks.

A token folder holds, for every written range of documents, three files without headers:

* ``part-N.bin``  ids of all documents one after the other, little-endian, 16 or 32 bits each
* ``part-N.idx``  unsigned 64-bit offsets, in ids from the start of the part: one per document and the end
* ``part-N.key``  signed 64-bit document ids (the smallest number stands for null)

and a manifest, a Parquet table of one row per part: its files, counts and ``base``, the number of
ids in all parts before it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import scratch_path, ship, small_batches
from regispark.llm.unit_table import UnitTable

NULL_KEY = -(1 << 63)
PART = "part int, name string, docs bigint, tokens bigint"
DOCUMENT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
#: Ids that a reading task holds at once.
READ_IDS = 4 << 20


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


#: Units in one text for the tokenizer, and texts in one call.
TOGETHER, BATCH = 64, 64


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> UnitTable:
    """The tokenizers library behind a table of units.

    Units are encoded many in one text: those that open with a blank one after the other, all
    others after a line feed each. Only the first id of a unit stands for a token that opens with
    a blank, or is the line feed, so the ids fall apart again at those.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    blank, feed = (tokenizer.encode(c, add_special_tokens=False).tokens[0][0] for c in " \n")
    vocabulary = tokenizer.get_vocab()
    opens = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in (blank, feed)}
    for token, id in vocabulary.items():
        for c, known in opens.items():
            known[id] = token[0] == c

    def ids_of(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def together(units: list[bytes], first: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that open alike, and how many each has."""
        texts = [b"".join(units[k : k + TOGETHER]).decode() for k in range(0, len(units), TOGETHER)]
        parts = []
        for at in range(0, len(texts), BATCH):
            encoded = tokenizer.encode_batch_fast(texts[at : at + BATCH], add_special_tokens=False)
            parts += [e.ids for e in encoded]
        ids = np.fromiter(chain.from_iterable(parts), np.uint32, sum(map(len, parts)))
        starts = np.flatnonzero(opens[first][ids])
        if len(starts) == len(units):
            return ids, np.diff(np.r_[starts, len(ids)])
        # A unit that does not fall apart as described.
        alone = [ids_of(u.decode()) for u in units]
        return np.concatenate(alone), np.array([len(a) for a in alone])

    def many(units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        opened = np.array([u[0] for u in units])
        first, count = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        pools, base = [np.zeros(0, np.uint32)], 0
        for own, mark, skip in ((opened == 32, blank, 0), (opened == 10, feed, 0), ((opened != 32) & (opened != 10), feed, 1)):
            own = np.flatnonzero(own)
            if not len(own):
                continue
            named = [units[k] for k in own.tolist()]
            ids, sizes = together([b"\n" + u for u in named] if skip else named, mark)
            first[own] = base + np.cumsum(sizes) - sizes + skip
            count[own] = sizes - skip
            pools.append(ids)
            base += len(ids)
        return first, count, np.concatenate(pools)

    return UnitTable(many, ids_of)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
    id: str = "doc_id", text: str = "text", width: int = 32,
) -> DataFrame:
    """Tokenizes ``docs`` and writes a token folder in ascending id order; returns the manifest.

    Documents are dealt into ranges of their ids and sorted within; every task tokenizes its range
    and writes it as it goes, so no task holds more than a batch. A rerun task writes files of a
    new name, and only those whose rows reach the manifest count. A null text is only its end id,
    null ids come first, rows with the same id stay and go by a hash of their text. An empty table
    gives an empty manifest. ``width`` is 16 or 32 bits; an id that does not fit is an error.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    kind = np.dtype({16: "<u2", 32: "<u4"}[width])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        table = _tokenizer(tokenizer_path)
        total = count = 0
        files = {}
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if not files:
                    files = {x: system.open_output_stream(f"{root}/{name}.{x}") for x in ("bin", "idx", "key")}
                own, sizes = table.encode([t or b"" for t in batch.column(1).to_pylist()])
                # Room for each document's end id behind its own.
                ends = np.cumsum(sizes + 1)
                ids = np.full(ends[-1], end_id, np.uint32)
                ids[np.arange(len(own)) + np.repeat(np.arange(len(sizes)), sizes)] = own
                if ids.max() > np.iinfo(kind).max:
                    raise ValueError(f"id {ids.max()} does not fit {width} bits")
                starts = total + ends - sizes - 1
                files["bin"].write(ids.astype(kind).tobytes())
                files["idx"].write(starts.astype("<u8").tobytes())
                files["key"].write(batch.column(0).fill_null(NULL_KEY).to_numpy().astype("<i8").tobytes())
                total, count = total + int(ends[-1]), count + len(sizes)
            if files:
                files["idx"].write(np.array([total], "<u8").tobytes())
        finally:
            for file in files.values():
                file.close()
        if count:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "name": name, "docs": count, "tokens": total}],
                pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]),
            )

    system, root = open_folder(folder)
    system.create_dir(root, recursive=True)
    ordered = (
        docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", F.xxhash64("text"))
        .select("id", F.col("text").cast("binary"))
    )
    # One row per task, so the prefix sum over all of them is small.
    parts = sorted(ordered.mapInArrow(run, PART).collect(), key=lambda r: r["part"])
    bases = [0, *accumulate(r["tokens"] for r in parts)]
    rows = [(*r, b, width) for r, b in zip(parts, bases)]
    manifest = spark.createDataFrame(rows, f"{PART}, base bigint, width int")
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _mapped(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's numbers: memory-mapped where it is local, else read."""
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, mode="r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of a token folder: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` (with the end id) and ``ids_crc32``. One task per part; ids are mapped, not loaded."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                base = f"{root}/{row['name']}"
                ids = _mapped(system, f"{base}.bin", f"<u{row['width'] // 8}")
                offsets = _mapped(system, f"{base}.idx", "<u8").astype(np.int64)
                keys = _mapped(system, f"{base}.key", "<i8")
                if len(keys) != row["docs"] or len(ids) != row["tokens"] or offsets[-1] != len(ids):
                    raise ValueError(f"{base}: files do not fit the manifest")
                for first in range(0, len(keys), 4096):
                    last = min(first + 4096, len(keys))
                    sums = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1])
                    ]
                    key = np.asarray(keys[first:last])
                    columns = [
                        pa.array(key, mask=key == NULL_KEY),
                        pa.array(offsets[first:last] + row["base"]),
                        pa.array(np.diff(offsets[first : last + 1])),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartition(max(1, manifest.count()), F.col("part"))
    return spread.mapInArrow(run, DOCUMENT)


def token_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian 32-bit) of every document of a token folder."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                base = f"{root}/{row['name']}"
                ids = _mapped(system, f"{base}.bin", f"<u{row['width'] // 8}")
                offsets = _mapped(system, f"{base}.idx", "<u8").astype(np.int64)
                keys = _mapped(system, f"{base}.key", "<i8")
                for first in range(0, len(keys), 256):
                    key = np.asarray(keys[first : first + 256])
                    ends = offsets[first : first + 257]
                    held = [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, mask=key == NULL_KEY), pa.array(held, pa.binary())], ["doc_id", "ids"]
                    )

    return manifest.mapInArrow(run, "doc_id bigint, ids binary")


def documents_read_back(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 16) -> DataFrame:
    """Writes a token folder below the shared scratch folder and reads its documents back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id, width=width), folder)
