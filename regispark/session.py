"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings the plans count on; all are Spark defaults or safe on any cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset: it then gets a fresh temporary folder. On a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="regispark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    Cuts lineage in a way that outlives any executor, and gives later joins a plain file scan
    with true sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors, once per Spark context.

    Functions that run in Python workers are pickled by name, so the workers must be able to
    import this package wherever the driver found it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.writestr(str(Path(package.name) / path.relative_to(package)), path.read_bytes())
    folder = tempfile.mkdtemp(prefix="regispark-")  # the driver serves the file from here
    target = os.path.join(folder, f"{package.name}.zip")
    Path(target).write_bytes(held.getvalue())
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, place = _at(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def create_new(spark: SparkSession, path: str) -> bool:
    """A new empty file; False if there is one."""
    files, place = _at(spark, path)
    if files.exists(place):
        return False
    try:
        files.create(place, False).close()
    except Exception as problem:
        if "AlreadyExists" in str(problem):
            return False
        raise
    return True


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is seen whole or not at all."""
    files, place = _at(spark, path)
    _, aside = _at(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if files.exists(place) or not files.rename(aside, place):
        files.delete(aside, False)
        raise RuntimeError(f"{path} exists")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def delete(spark: SparkSession, path: str) -> None:
    """Drops a file, or a folder with all that is in it."""
    files, place = _at(spark, path)
    files.delete(place, True)
