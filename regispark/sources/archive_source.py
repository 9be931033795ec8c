"""Zip archives as a data source: ``spark.read.format("registry_archives")`` and ``spark.readStream`` of it.

The directory of each archive is read once, when the scan is planned, and every member becomes a partition
of its own; ``containing`` leaves out members by their names before that. As a stream, the source's offset is
the listing itself (path, size and time of change of each archive), so a batch is what is new or changed
between two listings, the same after a restart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from regispark.session import ship
from regispark.sources.archives import archive_files, member_blocks, members_of

NAME = "registry_archives"
SCHEMA = "archive string, path string, member string, block bigint, data binary, error string"
_SCHEMA = pa.schema(
    [("archive", pa.string()), ("path", pa.string()), ("member", pa.string()), ("block", pa.int64()), ("data", pa.binary())]
    + [("error", pa.string())]
)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and the package to its executors."""
    ship(spark)
    spark.dataSource.register(ArchiveSource)


class MemberPartition(InputPartition):
    """One member of one archive; or an archive that cannot be read, with ``error``."""

    def __init__(self, archive: str, path: str, member: str | None, error: str | None):
        super().__init__((path, member))
        self.archive, self.path, self.member, self.error = archive, path, member, error


class ArchiveSource(DataSource):
    """Options: ``path`` (a folder), ``containing`` (part of a member's name), ``multiline`` (blocks of whole records
    instead of whole lines)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveStreamReader(dict(self.options))


class _Blocks:
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.containing = options.get("containing", "")
        self.multiline = options.get("multiline", "false").lower() == "true"

    def planned(self, paths: list[str]) -> list[InputPartition]:
        found = [MemberPartition(*row) for path in paths for row in members_of(path, self.containing)]
        return found or [MemberPartition("", "", None, None)]

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        if partition.path:
            for row in member_blocks(partition.archive, partition.path, partition.member, partition.error, self.multiline):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SCHEMA.types)], schema=_SCHEMA)


class ArchiveReader(_Blocks, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.planned([path for path, _, _ in archive_files(self.folder)])


class ArchiveStreamReader(_Blocks, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"archives": "{}"}

    def latestOffset(self) -> dict:
        listed = {path: [size, changed] for path, size, changed in archive_files(self.folder)}
        return {"archives": json.dumps(listed, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, now = json.loads(start["archives"]), json.loads(end["archives"])
        return self.planned(sorted(path for path, state in now.items() if before.get(path) != state))

    def commit(self, end: dict) -> None:
        pass
