"""Load one publication: scan, type, prune, write, swap."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.operators.prune import active_only, prune
from regispark.operators.typing import split_rejected, type_table
from regispark.schemas import DICTIONARIES, FACTS, FULL_KEY, KEY, TABLES
from regispark.session import materialize
from regispark.sinks.layout import ROWS_PER_FILE
from regispark.sinks.publications import Pinned, Publications
from regispark.sinks.tables import analyze, drop_tables, swap_table, write_indexed
from regispark.sources.archives import list_members, scan_archived_table
from regispark.sources.delimited import scan_table
from regispark.sources.files import list_files, route_files

ESTABLISHMENT = "estabelecimento"
REJECTS = "__rejects"
FRESH = "__new"
JOBS_AT_ONCE = 4


def read_publication(
    spark: SparkSession,
    folder: str,
    *,
    on_error: str = "fail",
    archived: bool = False,
    members: DataFrame | None = None,
    **scan_options,
) -> dict[str, DataFrame]:
    """Typed tables of a folder of files, or of the archives they come in; nothing runs yet. ``members`` is a
    listing of the archives made before, which spares one for each table."""
    read = scan_table
    if archived:
        read, scan_options = scan_archived_table, scan_options | {"members": members}
    return {
        name: type_table(
            read(spark, folder, table, on_error=on_error, **scan_options), table, on_error
        )
        for name, table in TABLES.items()
    }


def listed_members(spark: SparkSession, folder: str) -> DataFrame:
    """The archives' directories, read once and written."""
    return materialize(list_members(spark, folder), "members")


def missing_tables(
    spark: SparkSession, folder: str, *, archived: bool = False, members: DataFrame | None = None
) -> list[str]:
    """Tables that no file of the folder, or member of its archives, is for."""
    if archived:
        listed = list_members(spark, folder) if members is None else members
        listing = listed.select(F.element_at(F.split("member", "/"), -1).alias("name"))
    else:
        listing = list_files(spark, folder).select("name")
    found = {row["table"] for row in route_files(listing).select("table").distinct().collect()}
    return [name for name in TABLES if name not in found]


def load_publication(
    spark: SparkSession,
    folder: str,
    database: str,
    *,
    active: bool = True,
    exclude_special: bool = False,
    on_error: str = "fail",
    archived: bool = False,
    allow_missing: bool = False,
    **scan_options,
) -> dict[str, DataFrame]:
    """Read a publication and replace the tables of ``database`` with it.

    Establishments are filtered while they are written; the keys left decide which rows of the
    other facts are written at all. Every table is written once, straight from the scan and with
    Bloom filters on its keys, under a new name; the names are swapped after the last one
    succeeded. With ``active=False`` nothing is pruned. ``on_error="quarantine"`` also writes
    ``<table>__rejects``. A table without a file in the publication stops the load before anything
    is written, unless ``allow_missing``: then it becomes empty.
    """
    members = listed_members(spark, folder) if archived else None
    missing = [] if allow_missing else missing_tables(spark, folder, archived=archived, members=members)
    if missing:
        raise ValueError(f"no file for {', '.join(missing)} in {folder}")
    tables = read_publication(
        spark, folder, on_error=on_error, archived=archived, members=members, **scan_options
    )
    rejects: dict[str, DataFrame] = {}
    if on_error == "quarantine":
        for name, df in tables.items():
            # Parsed once for both the rows and the rejects.
            tables[name], rejects[name] = split_rejected(materialize(df, name))

    establishments = tables[ESTABLISHMENT]
    if active:
        establishments = active_only(establishments, exclude_special=exclude_special)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    dictionaries = {name: tables[name] for name in DICTIONARIES}
    _write_all(database, {ESTABLISHMENT: establishments, **dictionaries})
    others = {name: tables[name] for name in FACTS if name != ESTABLISHMENT}
    if active:
        written = spark.table(f"{database}.{ESTABLISHMENT}{FRESH}")
        others = prune(others, written)
    rejects = {f"{name}{REJECTS}": df for name, df in rejects.items()}
    _write_all(database, others | rejects)

    for name in [*TABLES, *rejects]:
        swap_table(spark, f"{database}.{name}{FRESH}", f"{database}.{name}")
    # Rejects of an earlier load do not belong to this one.
    drop_tables(spark, *[f"{database}.{name}{REJECTS}" for name in TABLES if f"{name}{REJECTS}" not in rejects])
    _at_once(lambda name: analyze(spark, f"{database}.{name}", *_keys(name)), list(TABLES))
    return {name: spark.table(f"{database}.{name}") for name in TABLES}


def publish_registry(
    spark: SparkSession,
    folder: str,
    root: str,
    snapshot: str,
    *,
    active: bool = True,
    exclude_special: bool = False,
    on_error: str = "fail",
    archived: bool = False,
    allow_missing: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    **scan_options,
) -> Pinned:
    """Read a publication and publish its ten tables as one snapshot in a new version below ``root``.

    Filters and checks are those of ``load_publication``. Tables are typed once into the scratch
    folder and written from there in key order, with file directories and statistics (see
    ``sinks.publications``). Readers see the version before until all tables are there, then all
    of them. Other snapshots stay; this one is replaced. With ``on_error="quarantine"`` the version also
    has ``<table>__rejects``.
    """
    members = listed_members(spark, folder) if archived else None
    missing = [] if allow_missing else missing_tables(spark, folder, archived=archived, members=members)
    if missing:
        raise ValueError(f"no file for {', '.join(missing)} in {folder}")
    store = Publications(spark, root)
    with store.publishing() as load:
        tables = read_publication(
            spark, folder, on_error=on_error, archived=archived, members=members, **scan_options
        )
        rejects: dict[str, DataFrame] = {}
        if on_error == "quarantine":
            for name, df in tables.items():
                tables[name], rejects[f"{name}{REJECTS}"] = split_rejected(materialize(df, name))

        def write(name: str, df: DataFrame) -> None:
            keys = _keys(name)
            if keys:
                load.write(name, materialize(df, name), snapshot, keys, rows_per_file=rows_per_file)
            else:
                load.write(name, df, snapshot, ["codigo"] if name in DICTIONARIES else [], clustered=False)

        establishments = tables[ESTABLISHMENT]
        if active:
            establishments = active_only(establishments, exclude_special=exclude_special)
        first = {ESTABLISHMENT: establishments, **{name: tables[name] for name in DICTIONARIES}}
        _at_once(lambda name: write(name, first[name]), list(first))
        others = {name: tables[name] for name in FACTS if name != ESTABLISHMENT}
        if active:
            others = prune(others, load.read(ESTABLISHMENT, snapshot))
        others |= rejects
        _at_once(lambda name: write(name, others[name]), list(others))
        return store.pin(load.commit())


def _write_all(database: str, tables: dict[str, DataFrame]) -> None:
    def write(name: str) -> None:
        fresh = f"{database}.{name}{FRESH}"
        drop_tables(tables[name].sparkSession, fresh)
        write_indexed(tables[name], fresh, *_keys(name))

    _at_once(write, list(tables))


def _keys(name: str) -> list[str]:
    if name not in FACTS:  # dictionaries, and rejects
        return []
    return [KEY, FULL_KEY] if name == ESTABLISHMENT else [KEY]


def _at_once(run: Callable[[str], None], names: list[str]) -> None:
    """Independent jobs submitted together: the last tasks of one leave no executor idle."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(run, names))
