"""Files and archives of a folder as they arrive or change, each loaded once, in bounded batches.

A file is known by its path, size and time of change. A batch reads some files that are not known, writes
their rows with a list of the files, and is entered in the log by one rename: it counts whole or
not at all, also after a restart. Rows belong to the batch that read them; when a file comes
again, the rows of its latest batch are the table's, and those of earlier ones are not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regispark.operators.numbering import Chunks, sorted_runs
from regispark.operators.sizing import broadcast_if_small
from regispark.operators.typing import type_table
from regispark.schemas import Table
from regispark.session import exists, materialize, names_in, put_text
from regispark.sources.archives import list_members, scan_members
from regispark.sources.delimited import parse_lines, without_missing

FILES_PER_BATCH = 1000
PATH, BATCH = "_path", "_batch"
STATE = "path string, size bigint, changed timestamp"


class FileIngest:
    """One table fed from one folder; ``target`` is a folder of its own.

    ``archived`` reads the members of zip archives whose names hold the table's token. Rows are cleaned and
    typed as in a batch load, the full key and ``na_tokens`` included.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        target: str,
        table: Table,
        *,
        glob: str = "*",
        archived: bool = False,
        files_per_batch: int = FILES_PER_BATCH,
        encoding: str = "cp1252",
        na_tokens: tuple[str, ...] = (),
    ):
        self.spark, self.folder, self.target, self.table = spark, folder, target.rstrip("/"), table
        self.glob, self.archived, self.files_per_batch = glob, archived, files_per_batch
        self.encoding, self.na_tokens = encoding, na_tokens

    def batches(self) -> dict[int, str]:
        """Folders of the batches that count, by number; the log is read in one job."""
        if not self._numbers():
            return {}
        name = F.col("_metadata.file_name").alias("name")
        log = self.spark.read.option("pathGlobFilter", "*.txt").text(f"{self.target}/log", wholetext=True)
        found = {r["name"]: r["value"] for r in log.select(name, "value").collect()}
        return {int(n[:-4]): found[n] for n in sorted(found) if n[:-4].isdigit()}

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.target}/log")
        return [int(n[:-4]) for n in names if n.endswith(".txt") and n[:-4].isdigit()]

    def _read(self, part: str, schema: T.StructType | str | None = None) -> DataFrame | None:
        """One part of all batches that count, in one scan; the number of a row's batch is in its file's path."""
        batches = self.batches()
        if not batches:
            return None
        paths = [f"{self.target}/{folder}/{part}" for folder in batches.values()]
        schema = schema or self.spark.read.parquet(paths[-1]).schema
        number = F.regexp_extract("_metadata.file_path", r"/batches/(\d+)-[0-9a-f]+/[^/]+/[^/]+$", 1)
        return self.spark.read.schema(schema).parquet(*paths).withColumn(BATCH, number.cast("int"))

    def known(self) -> DataFrame:
        """The files that were read, as they were the last time: ``path``, ``size``, ``changed``, ``_batch``."""
        every = self._read("files", STATE)
        if every is None:
            return self.spark.createDataFrame([], f"{STATE}, {BATCH} int")
        last = Window.partitionBy("path").orderBy(F.desc(BATCH))
        return every.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def pending(self) -> DataFrame:
        """Files of the folder that were not read yet, or have changed since."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", self.glob).load(self.folder)
        listed = listed.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("changed"),
        )
        return listed.join(self.known().drop(BATCH), ["path", "size", "changed"], "left_anti")

    def run(self) -> int:
        """Reads all that is pending, oldest files first; the number of batches that took.

        The folder and the state are read once for all batches, and again for what came meanwhile, so the
        time of a batch does not grow with their number.
        """
        done, number = 0, max(self._numbers(), default=-1) + 1
        while count := (planned := materialize(self.pending(), "pending")).count():
            chunks = Chunks(sorted_runs(planned, ["changed", "path"]))
            for skip in range(0, count, self.files_per_batch):
                files = chunks.rows(skip, self.files_per_batch).orderBy("changed", "path").collect()
                number = self._load(files, number) + 1
                done += 1
        return done

    def rows(self) -> DataFrame:
        """The table: the rows of each file's latest reading, with the file's ``_path``."""
        every = self._read("rows")
        if every is None:
            raise ValueError(f"nothing was read into {self.target} yet")
        ((known, _),) = broadcast_if_small(self.known().select(F.col("path").alias(PATH), BATCH))
        return every.join(known, [PATH, BATCH], "left_semi").drop(BATCH)

    def _load(self, files: list, number: int) -> int:
        while exists(self.spark, self._entry(number)):
            number += 1
        folder = f"batches/{number:08d}-{uuid.uuid4().hex}"
        rows = self._rows([f["path"] for f in files])
        rows.write.parquet(f"{self.target}/{folder}/rows")
        state = self.spark.createDataFrame(files, STATE)
        state.coalesce(1).write.parquet(f"{self.target}/{folder}/files")
        put_text(self.spark, self._entry(number), folder)
        return number

    def _entry(self, number: int) -> str:
        return f"{self.target}/log/{number:08d}.txt"

    def _rows(self, paths: list[str]) -> DataFrame:
        names = self.table.names
        if self.archived:
            members = list_members(self.spark, paths)
            staging = scan_members(members, names, containing=self.table.token, encoding=self.encoding, keep=True)
            staging = staging.withColumnRenamed("path", PATH)
        else:
            lines = self.spark.read.option("lineSep", "\n").text(paths)
            lines = lines.withColumn(PATH, F.col("_metadata.file_path"))
            staging = parse_lines(lines, names, encoding=self.encoding, keep=[PATH])
        staging = without_missing(staging, names, self.na_tokens)
        return type_table(staging, self.table, keep=[PATH])
