"""Zip archives as distributed lines.

One task per archive member inflates it as a stream and emits blocks of whole lines, so nothing
is held whole; Spark then spreads the blocks over the cluster for decoding and parsing. No
extracted copy is needed. A bad archive or member becomes a row with ``error`` set.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.schemas import Table
from regispark.session import ship
from regispark.sources.delimited import parse_lines, parse_records, recoded, without_missing
from regispark.sources.files import LEFTOVER, is_leftover, list_files
from regispark.sources.multiline import closed_length, records_of

BLOCK_BYTES = 4 * 1024 * 1024
#: Longest line or record of a member, in bytes; more is taken for damage.
LONGEST = 64 * 1024 * 1024

MEMBERS = "archive string, path string, member string, size bigint, error string"
BLOCKS = "archive string, path string, member string, block bigint, data binary, error string"


def list_members(spark: SparkSession, folder: str | Sequence[str], glob: str = "*.zip") -> DataFrame:
    """One row per member of each archive of a folder, or of the archives named, or one row with ``error`` for
    an unreadable archive.

    Only the archives' directories are read. Give it, ``materialize``d, to the scans of several tables.
    """
    archives = list_files(spark, folder, glob).select("name", "path")
    ship(spark)
    return _spread(archives).mapInPandas(_members, MEMBERS)


def expand_archives(
    spark: SparkSession,
    folder: str,
    glob: str = "*.zip",
    containing: str = "",
    whole: bool = False,
    multiline: bool = False,
    members: DataFrame | None = None,
) -> DataFrame:
    """``(archive, path, member, block, data, error)``: members as blocks of whole lines, or with ``multiline`` of
    whole records, NULs removed.

    ``containing`` picks members by a part of their name; only these are inflated. ``members`` is a listing
    made before. With ``whole`` every member is inflated once to see that it is sound, so a damaged one gives its error and no
    blocks; without it, blocks come before damage further on is found.
    """
    if members is None:
        members = list_members(spark, folder, glob)
    name = F.element_at(F.split("member", "/"), -1)
    members = members.where(F.col("member").isNull() | name.contains(containing) & ~is_leftover(name))
    ship(spark)
    return _spread(members).mapInPandas(_block_reader(whole, multiline), BLOCKS)


def archive_report(blocks: DataFrame) -> DataFrame:
    """``(archive, member, size, error)`` of expanded archives."""
    return blocks.groupBy("archive", "member").agg(
        F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).cast("bigint").alias("size"),
        F.max("error").alias("error"),
    )


def archive_lines(blocks: DataFrame, on_error: str = "fail", multiline: bool = False) -> DataFrame:
    """``(archive, path, member, value)``: one row per line, or per record of blocks made with ``multiline``,
    decoded as ISO-8859-1.

    Blocks are spread over the cluster first, whatever member they come from. An unreadable archive
    or member fails the job, or with ``on_error="quarantine"`` gives no rows.
    """
    if on_error == "fail":
        data = blocks.where(F.col("data").isNotNull() | F.col("error").isNotNull())
        told = F.concat_ws(" ", F.lit("unreadable archive:"), "archive", "member", "error")
        checked = F.when(F.col("error").isNotNull(), F.raise_error(told).cast("binary")).otherwise(F.col("data"))
        data = data.withColumn("data", checked)
    else:
        data = blocks.where(F.col("data").isNotNull())
    data = data.repartition("archive", "member", "block")
    if multiline:
        ship(data.sparkSession)
        return data.select("archive", "path", "member", "data").mapInPandas(
            _records, "archive string, path string, member string, value string"
        )
    text = F.rtrim(F.decode("data", "ISO-8859-1"), F.lit("\n"))
    return data.select("archive", "path", "member", F.explode(F.split(text, "\n", -1)).alias("value"))


def scan_archives(spark: SparkSession, folder: str | Sequence[str], names: list[str], **options) -> DataFrame:
    """Staging rows straight from archives; options as for ``scan_members``."""
    return scan_members(list_members(spark, folder), names, **options)


def scan_members(
    members: DataFrame,
    names: list[str],
    *,
    containing: str = "",
    na_tokens: Sequence[str] = (),
    on_error: str = "fail",
    multiline: bool = False,
    encoding: str = "cp1252",
    keep: bool = False,
) -> DataFrame:
    """Staging rows of the members listed, as ``delimited.scan`` gives them for files; ``multiline`` allows line
    breaks inside quotes, ``keep`` keeps the ``path`` of each row's archive.

    An unreadable archive or member fails the job. With ``on_error="quarantine"`` it gives no rows at
    all, and ``archive_report`` names it.
    """
    spark = members.sparkSession
    blocks = expand_archives(
        spark, "", containing=containing, whole=on_error != "fail", multiline=multiline, members=members
    )
    lines = archive_lines(blocks, on_error, multiline)
    kept = ["path"] if keep else []
    if multiline:
        whole = lines.select(*kept, recoded(F.col("value"), encoding).alias("value"), F.lit(True).alias("whole"))
        rows = parse_records(whole, names, on_error=on_error, keep=kept)
    else:
        rows = parse_lines(lines, names, decoded=True, encoding=encoding, on_error=on_error, keep=kept)
    return without_missing(rows, names, na_tokens)


def scan_archived_table(
    spark: SparkSession, folder: str, table: Table, members: DataFrame | None = None, **options
) -> DataFrame:
    """Staging rows of every archived file whose name holds the table's token."""
    listed = list_members(spark, folder) if members is None else members
    return scan_members(listed, table.names, containing=table.token, **options)


def _spread(df: DataFrame) -> DataFrame:
    # One archive or member per task; a fixed count, so that AQE does not merge these tiny rows.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _open(path: str):
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
    return files.open_input_file(name)


def archive_files(folder: str, suffix: str = ".zip") -> list[tuple[str, int, int]]:
    """Path, size and time of change of the archives of a folder, from its listing."""
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(re.sub("^file:/+", "/", folder))
    found = files.get_file_info(fs.FileSelector(name))
    kept = [f for f in found if f.is_file and f.path.lower().endswith(suffix)]
    base = folder.rstrip("/")
    return sorted((f"{base}/{f.base_name}", f.size, f.mtime_ns or 0) for f in kept)


def members_of(path: str, containing: str = "") -> list[tuple[str, str, str | None, str | None]]:
    """``(archive, path, member, error)`` of the members of an archive whose names hold a text, from its directory."""
    name = path.rsplit("/", 1)[-1]
    try:
        with _open(path) as handle, zipfile.ZipFile(handle) as archive:
            listed = [i.filename for i in archive.infolist() if not i.is_dir()]
    except Exception as problem:
        return [(name, path, None, f"{type(problem).__name__}: {problem}")]
    bases = ((m, m.rsplit("/", 1)[-1]) for m in listed)
    return [(name, path, m, None) for m, base in bases if containing in base and not base.lower().endswith(LEFTOVER)]


def member_blocks(
    name: str, path: str, member: str | None, error: str | None, multiline: bool = False, whole: bool = False
) -> Iterator[tuple]:
    """Rows of ``BLOCKS`` of one member, which is inflated as a stream."""
    if member is None:
        yield name, path, None, None, None, error
        return
    cut = _whole_records if multiline else _whole_lines
    number = -1
    try:
        with _open(path) as handle, zipfile.ZipFile(handle) as archive:
            if whole:
                with archive.open(member) as stream:
                    while stream.read(BLOCK_BYTES):  # ends in a check of the sum
                        pass
            with archive.open(member) as stream:
                for number, data in enumerate(cut(stream)):
                    yield name, path, member, number, data, None
        if number < 0:
            yield name, path, member, 0, b"", None
    except Exception as problem:  # report a damaged member, go on with the next
        yield name, path, member, number + 1, None, f"{type(problem).__name__}: {problem}"


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "path", "member", "size", "error"]
    for batch in batches:
        rows = []
        for name, path in zip(batch["name"], batch["path"]):
            try:
                with _open(path) as handle, zipfile.ZipFile(handle) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            rows.append((name, path, info.filename, info.file_size, None))
            except Exception as problem:  # one bad archive must not stop the others
                rows.append((name, path, None, None, f"{type(problem).__name__}: {problem}"))
        yield pd.DataFrame(rows, columns=columns)


def _block_reader(whole: bool, multiline: bool):
    columns = [part.split()[0] for part in BLOCKS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for one in zip(batch["archive"], batch["path"], batch["member"], batch["error"]):
                for row in member_blocks(*one, multiline, whole):
                    yield pd.DataFrame([row], columns=columns)

    return run


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for archive, path, member, data in zip(batch["archive"], batch["path"], batch["member"], batch["data"]):
            values = [record.decode("latin-1") for record in records_of(bytes(data))]
            # Texts even without a record: a column of nothing would be numbers.
            yield pd.DataFrame({"archive": archive, "path": path, "member": member, "value": values}, dtype=object)


def _whole_lines(stream) -> Iterator[bytes]:
    rest: list[bytes] = []
    while chunk := stream.read(BLOCK_BYTES):
        head, newline, tail = chunk.rpartition(b"\n")
        if newline:
            yield b"".join([*rest, head, newline])
            rest = []
        rest.append(tail)
        if sum(map(len, rest)) > LONGEST:
            raise ValueError(f"a line of more than {LONGEST} bytes")
    if any(rest):
        yield b"".join(rest)


def _whole_records(stream) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(max(BLOCK_BYTES, len(rest))):
        rest += chunk.replace(b"\x00", b"")
        size = closed_length(rest)
        if size:
            yield rest[:size]
        rest = rest[size:]
        if len(rest) > LONGEST:
            raise ValueError(f"a record of more than {LONGEST} bytes")
    if rest:
        yield rest
