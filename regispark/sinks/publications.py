"""Versioned publications: several tables change together, by one new manifest.

Below a root folder, ``data/<table>/snapshot=<value>/load=<id>`` holds the files of one load, and
``manifests/<version>.json`` says which of them make up a version, with their statistics and file directories.
A manifest is written aside and renamed: it is there whole or not at all, and the greatest version is
the current one. Readers that pinned an older version go on with it, as no file is changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regispark.operators import statistics
from regispark.operators.statistics import Statistics
from regispark.session import create_new, delete, names_in, put_text, read_text
from regispark.sinks.layout import file_directory, lookup, write_clustered

SNAPSHOT = "snapshot"
LOAD = "load"
CLAIM = "claim"


class Publications:
    """The versions below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        """Numbers of all published versions, ascending."""
        names = names_in(self.spark, f"{self.root}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def pin(self, version: int | None = None) -> Pinned:
        """One version, by default the current one; what is published later does not change it."""
        known = self.versions()
        if version is None and not known:
            return Pinned(self.spark, self.root, 0, {})
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"no version {version} in {self.root}")
        return Pinned(self.spark, self.root, version, json.loads(read_text(self.spark, self._manifest(version))))

    @contextmanager
    def publishing(self) -> Iterator[Load]:
        """A new load; nothing of it is seen before its ``commit``. One at a time: a second one is refused
        until the first has ended, or its claim was dropped with ``release``."""
        claim = f"{self.root}/manifests/{CLAIM}"
        if not create_new(self.spark, claim):
            raise RuntimeError(f"another load is publishing: {claim} exists")
        try:
            yield Load(self)
        finally:
            self.release()

    def release(self) -> None:
        """Drops the claim of a load that died."""
        delete(self.spark, f"{self.root}/manifests/{CLAIM}")

    def expire(self, keep: int) -> None:
        """Drops all versions but the last ``keep``, and the loads that no other version holds."""
        if keep < 1:
            raise ValueError("keep the current version at least")
        known = self.versions()
        kept = {part["path"] for v in known[-keep:] for part in self.pin(v).parts()}
        for version in known[:-keep]:
            gone = [part for part in self.pin(version).parts() if part["path"] not in kept]
            delete(self.spark, self._manifest(version))
            for part in gone:
                for path in (part["path"], part["files"], part["statistics"]):
                    if path:
                        delete(self.spark, path)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"


class Load:
    """Tables on their way into a new version."""

    def __init__(self, store: Publications):
        self.store, self.id = store, uuid.uuid4().hex
        self.written: dict[tuple[str, str], dict] = {}

    def write(self, table: str, df: DataFrame, snapshot: str, keys: Sequence[str] = (), *, clustered: bool = True, **layout) -> None:
        """Writes the rows of one snapshot of a table, laid out by ``keys`` if ``clustered``, and measures them.

        A snapshot of the table that the version before has is replaced.
        """
        spark, root = self.store.spark, self.store.root
        path = f"{root}/data/{table}/{SNAPSHOT}={snapshot}/{LOAD}={self.id}"
        if keys and clustered:
            write_clustered(df, path, keys, **layout)
        else:
            df.write.parquet(path)
        meta = f"{root}/meta/{table}/{snapshot}/{self.id}"
        read = spark.read.schema(df.schema).parquet(path)
        files = None
        if keys and clustered:
            files = f"{meta}/files"
            file_directory(read, keys).coalesce(1).write.parquet(files)
        statistics.measure(read, keys).coalesce(1).write.parquet(f"{meta}/statistics")
        self.written[table, str(snapshot)] = {
            "table": table, "snapshot": str(snapshot), "path": path, "schema": df.schema.json(), "keys": list(keys),
            "files": files, "statistics": f"{meta}/statistics",
        }

    def read(self, table: str, snapshot: str) -> DataFrame:
        """What this load wrote."""
        part = self.written[table, str(snapshot)]
        return self.store.spark.read.schema(T.StructType.fromJson(json.loads(part["schema"]))).parquet(part["path"])

    def commit(self) -> int:
        """Publishes all that was written, beside what the current version has of other snapshots."""
        store = self.store
        before = store.pin()
        parts = {(p["table"], p["snapshot"]): p for p in before.parts()} | self.written
        version = before.version + 1
        told = json.dumps({"parts": [parts[k] for k in sorted(parts)]}, indent=1)
        put_text(store.spark, store._manifest(version), told)
        return version


class Pinned:
    """One version of all tables."""

    def __init__(self, spark: SparkSession, root: str, version: int, manifest: dict):
        self.spark, self.root, self.version, self._manifest = spark, root, version, manifest

    def parts(self, table: str | None = None, snapshot: str | None = None) -> list[dict]:
        found = self._manifest.get("parts", [])
        return [p for p in found if table in (None, p["table"]) and (snapshot is None or str(snapshot) == p["snapshot"])]

    def tables(self) -> list[str]:
        return sorted({p["table"] for p in self.parts()})

    def snapshots(self, table: str) -> list[str]:
        return sorted(p["snapshot"] for p in self.parts(table))

    def table(self, name: str) -> DataFrame:
        """All snapshots of a table, with a text column ``snapshot`` that prunes files."""
        parts = self._known(name)
        reader = self.spark.read.schema(self._schema(parts)).option("basePath", f"{self.root}/data/{name}")
        return reader.parquet(*[p["path"] for p in parts]).drop(LOAD)

    def statistics(self, name: str, snapshot: str | None = None) -> Statistics:
        """Statistics of one snapshot, or of all together, read from what the loads measured."""
        parts = self._known(name, snapshot)
        read = reduce(
            DataFrame.unionByName,
            [self.spark.read.schema(statistics.COLUMNS).parquet(p["statistics"]) for p in parts],
        )
        return statistics.told(statistics.merged(read) if len(parts) > 1 else read)

    def lookup(self, name: str, key: str, *values: object, snapshot: str | None = None) -> DataFrame:
        """Rows of a table with one of a few values of a key; of its files, those are opened that may hold one."""
        parts = self._known(name, snapshot)
        if not all(p["files"] and key in p["keys"] for p in parts):
            rows = self.table(name).where(F.col(key).isin(list(values)))
            return rows if snapshot is None else rows.where(F.col(SNAPSHOT) == str(snapshot))
        directory = reduce(DataFrame.unionByName, [self.spark.read.parquet(p["files"]) for p in parts])
        base = f"{self.root}/data/{name}"
        like = self.spark.createDataFrame([], self._schema(parts))
        return lookup(self.spark, directory, like, key, values, base).drop(LOAD)

    def _known(self, name: str, snapshot: str | None = None) -> list[dict]:
        parts = self.parts(name, snapshot)
        if not parts:
            raise ValueError(f"no table {name}" + (f" of {snapshot}" if snapshot else "") + f" in version {self.version}")
        return parts

    @staticmethod
    def _schema(parts: list[dict]) -> T.StructType:
        fields = T.StructType.fromJson(json.loads(parts[-1]["schema"])).fields
        return T.StructType([*fields, T.StructField(SNAPSHOT, T.StringType()), T.StructField(LOAD, T.StringType())])
