"""Key layout, statistics, and versions of several tables that change together."""

import pytest
from pyspark.sql import functions as F

from regispark.operators import statistics
from regispark.operators.enrich import described_list
from regispark.plans import load as loading
from regispark.plans.profile import loaded_profile
from regispark.schemas import FULL_KEY, KEY, TABLES
from regispark.sinks import publications
from regispark.sinks.layout import file_directory, files_with, write_clustered
from regispark.sinks.publications import Publications
from regispark.streaming.files import FileIngest


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def establishments(spark, tmp_path_factory):
    """Two million full keys in any order, a third of them of one company."""
    path = str(tmp_path_factory.mktemp("typed") / "t")
    key = F.when(F.col("id") % 3 == 0, F.lit("77777777")).otherwise(F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**8)).cast("string"), 8, "0"))
    rows = spark.range(2_000_000).select(key.alias(KEY), F.concat(key, F.lpad(F.col("id").cast("string"), 8, "0")).alias(FULL_KEY), "id")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_a_lookup_opens_few_files_and_row_groups(spark, tmp_path, establishments):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    write_clustered(establishments, path, [KEY, FULL_KEY], rows_per_file=100_000)
    written = spark.read.parquet(path)
    directory = file_directory(written, [KEY, FULL_KEY])
    files = directory.collect()
    assert len(files) >= 18 and sum(f["rows"] for f in files) == 2_000_000
    assert max(f["rows"] for f in files) <= 250_000  # the hot company too is split
    wanted = establishments.where("id = 123456").first()[FULL_KEY]
    found = files_with(directory, FULL_KEY, [wanted])
    assert len(found) == 1
    told = pq.ParquetFile(found[0].removeprefix("file://"))
    assert told.metadata.num_row_groups <= 3
    assert told.metadata.row_group(0).column(1).statistics.min is not None
    assert len(files_with(directory, KEY, ["77777777"])) >= 6
    assert files_with(directory, FULL_KEY, ["zzz"]) == []


def test_bloom_filters_are_sized_by_what_was_measured(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias(KEY), (F.col("id") % 5).cast("string").alias("few"))
    sizes = []
    for keys in ([KEY], ["few"]):
        path = tmp_path / keys[0]
        write_clustered(rows, str(path), keys, rows_per_file=50_000)
        sizes.append(sum(f.stat().st_size for f in path.glob("*.parquet")))
    plain = tmp_path / "plain"
    rows.sort(KEY).coalesce(1).write.parquet(str(plain))
    base = sum(f.stat().st_size for f in plain.glob("*.parquet"))
    assert 10_000 < sizes[0] - base < 100_000  # of 20,000 keys, not of the megabyte that is the default
    assert sizes[1] < base + 10_000


def test_statistics_are_merged(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    other = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3), ("d", None)], "k string, v int")
    first, second = (statistics.measure(df, ["k", "v"]) for df in (one, other))
    told = statistics.told(first)
    assert (told.rows, told.most, told.distinct, told.nulls) == (3, {"k": 1, "v": 1}, {"k": 2, "v": 3}, {"k": 1, "v": 0})
    assert told.unique("k") is True and told.hot("k", 2) is False and told.unique("x") is None
    assert statistics.told(second).unique("k") is False
    both = statistics.told(statistics.merged(first.unionByName(second)))
    assert both.rows == 7 and both.bytes == told.bytes + statistics.told(second).bytes
    assert both.distinct == {"k": 4, "v": 3} and both.nulls == {"k": 1, "v": 1}
    assert both.unique("k") is None and both.hot("k", 3) is True and both.hot("k", 4) is False
    empty = statistics.told(statistics.measure(one.limit(0), ["k"]))
    assert (empty.rows, empty.bytes, empty.unique("k")) == (0, 0, True)


@pytest.fixture
def raw_folder(spark, tmp_path):
    def write(name, names=("Acme", "Other")):
        folder = tmp_path / name
        folder.mkdir()
        for table in TABLES.values():
            (folder / f"F.{table.token}").write_text("\n")
        blank = ";".join([""] * 21)
        for k, company in enumerate(names):
            with (folder / "F.EMPRE").open("a") as file:
                file.write(f"{k:08d};{company};1;2;3,00;1;\n")
            with (folder / "F.ESTABELE").open("a") as file:
                row = [f"{k:08d}", "0001", "00", "1", "", "02", "20200101", "0", "", "", "20200101", "0111301", "0111302,9", "", "", "", "", "", "", "SP", "7"]
                file.write(";".join(row + [""] * 9) + "\n")
        (folder / "F.CNAE").write_text("0111301;main\n0111302;side\n")
        (folder / "F.MUNIC").write_text("7;Town\n")
        return str(folder), blank

    return lambda *args: write(*args)[0]


def names_of(registry, snapshot):
    return sorted(r["razao_social"] for r in registry.table("empresa").where(F.col("snapshot") == snapshot).collect())


def test_publish_replace_pin_and_expire(spark, tmp_path, raw_folder, explain):
    root = str(tmp_path / "registry")
    store = Publications(spark, root)
    assert store.versions() == [] and store.pin().tables() == []
    first = loading.publish_registry(spark, raw_folder("a"), root, "2025-08")
    assert first.version == 1 and first.tables() == sorted(TABLES)
    second = loading.publish_registry(spark, raw_folder("b", ("New",)), root, "2025-09")
    third = loading.publish_registry(spark, raw_folder("c", ("Fixed",)), root, "2025-09")
    assert names_of(third, "2025-08") == ["Acme", "Other"] and names_of(third, "2025-09") == ["Fixed"]
    assert names_of(second, "2025-09") == ["New"] and first.snapshots("empresa") == ["2025-08"]
    assert names_of(store.pin(2), "2025-09") == ["New"]
    plan = explain(third.table("empresa").where(F.col("snapshot") == "2025-09"))
    assert "PartitionFilters: [isnotnull(snapshot" in plan
    assert values(third.lookup("estabelecimento", "cnpj", "00000000000100").select("snapshot")) == [("2025-08",), ("2025-09",)]
    assert third.lookup("estabelecimento", "cnpj", "00000000000100", snapshot="2025-09").count() == 1
    assert third.lookup("estabelecimento", "cnpj", "nobody").collect() == []
    assert third.lookup("cnae", "codigo", "0111301", snapshot="2025-09").count() == 1
    assert third.statistics("empresa").rows == 3 and third.statistics("empresa", "2025-09").rows == 1
    profile = loaded_profile(third, "2025-09")
    assert [r["razao_social"] for r in profile.collect()] == ["Fixed"]
    assert "PartitionFilters: [isnotnull(snapshot" in explain(profile)
    store.expire(1)
    assert store.versions() == [3] and names_of(store.pin(), "2025-08") == ["Acme", "Other"]
    with pytest.raises(Exception):
        second.table("empresa").where("snapshot = '2025-09'").collect()
    with pytest.raises(ValueError, match="no version 2"):
        store.pin(2)
    with pytest.raises(ValueError, match="no table nothing"):
        store.pin().table("nothing")


def test_a_failure_between_any_two_steps_leaves_the_old_tables(spark, tmp_path, raw_folder, monkeypatch):
    root = str(tmp_path / "registry")
    store = Publications(spark, root)
    loading.publish_registry(spark, raw_folder("a"), root, "2025-09")
    newer = raw_folder("b", ("New",))
    plain_write, plain_put = publications.Load.write, publications.put_text
    monkeypatch.setattr(loading, "JOBS_AT_ONCE", 1)
    for step in (7, "commit"):
        calls = iter(range(99))

        def write(self, *args, **options):
            if next(calls) == step:
                raise OSError("lost")
            plain_write(self, *args, **options)

        def put(*args):
            if step == "commit":
                raise OSError("lost")
            plain_put(*args)

        monkeypatch.setattr(publications.Load, "write", write)
        monkeypatch.setattr(publications, "put_text", put)
        with pytest.raises(OSError, match="lost"):
            loading.publish_registry(spark, newer, root, "2025-09")
        assert store.versions() == [1] and names_of(store.pin(), "2025-09") == ["Acme", "Other"]
    monkeypatch.setattr(publications.Load, "write", plain_write)
    monkeypatch.setattr(publications, "put_text", plain_put)
    assert names_of(loading.publish_registry(spark, newer, root, "2025-09"), "2025-09") == ["New"]


def test_one_load_at_a_time(spark, tmp_path):
    store = Publications(spark, str(tmp_path / "registry"))
    with store.publishing() as load:
        with pytest.raises(RuntimeError, match="another load"):
            with store.publishing():
                pass
        load.write("t", spark.range(3), "1")
    assert store.versions() == []  # nothing was committed
    publications.create_new(spark, f"{store.root}/manifests/claim")  # of a load that died
    with pytest.raises(RuntimeError, match="another load"):
        with store.publishing():
            pass
    store.release()
    with store.publishing() as load:
        load.write("t", spark.range(3), "1")
        assert load.commit() == 1
    assert store.pin().table("t").count() == 3


def test_a_profile_of_loaded_tables_runs_few_jobs(spark, tmp_path, raw_folder):
    registry = loading.publish_registry(spark, raw_folder("a"), str(tmp_path / "registry"), "2025-09")
    group = "profile-jobs"
    spark.sparkContext.setJobGroup(group, "")
    loaded_profile(registry, "2025-09", prefix="A")
    statistics_jobs = 4  # one for each table's statistics, of a few rows
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 3 + statistics_jobs


def test_rejects_of_an_earlier_load_are_dropped(spark, tmp_path, raw_folder):
    bad = raw_folder("bad")
    with open(f"{bad}/F.EMPRE", "a") as file:
        file.write("00000009;Bad;x;2;3,00;1;\n")
    spark.sql("DROP DATABASE IF EXISTS rejects_db CASCADE")
    loading.load_publication(spark, bad, "rejects_db", on_error="quarantine")
    assert spark.table("rejects_db.empresa__rejects").count() == 1
    loading.load_publication(spark, raw_folder("good"), "rejects_db")
    assert not spark.catalog.tableExists("rejects_db.empresa__rejects")
    registry = loading.publish_registry(spark, bad, str(tmp_path / "registry"), "1", on_error="quarantine")
    assert registry.table("empresa__rejects").count() == 1


def test_a_changed_file_replaces_its_own_rows(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    munic = TABLES["munic"]

    def ingest(**options):
        loading_ = FileIngest(spark, str(source), target, munic, na_tokens=("NA",), **options)
        return loading_.run(), values(loading_.rows().drop("_path"))

    (source / "a").write_text("1;x\n2;NA\n")
    (source / "b").write_text("3;y\n")
    assert ingest(files_per_batch=1) == (2, [(1, "x"), (2, None), (3, "y")])
    assert ingest() == (0, [(1, "x"), (2, None), (3, "y")])
    (source / "a").write_text("1;changed\n")
    (source / "c").write_text("4;z\n")
    assert ingest() == (1, [(1, "changed"), (3, "y"), (4, "z")])
    # A batch that was not entered in the log does not count, and is read again.
    (source / "d").write_text("5;d\n")
    late = FileIngest(spark, str(source), target, munic)
    from regispark.streaming import files

    plain = files.put_text
    files.put_text = lambda *args: (_ for _ in ()).throw(OSError("lost"))
    try:
        with pytest.raises(OSError):
            late.run()
    finally:
        files.put_text = plain
    assert len(late.rows().collect()) == 3
    assert ingest() == (1, [(1, "changed"), (3, "y"), (4, "z"), (5, "d")])


@pytest.mark.parametrize("limit", [0, 10**6])
def test_lists_are_described_in_order(spark, limit):
    texts = spark.createDataFrame([("1", "one"), ("2", "two"), ("2", "zwei"), (None, "none"), ("4", None)], "codigo string, descricao string")
    rows = [(1, "2,1,2"), (2, None), (3, ""), (4, "9,1,,4"), (5, "1")] + [(k, "1,2") for k in range(6, 60)]
    df = spark.createDataFrame(rows, "id int, list string")
    found = described_list(df, "list", texts, "described", limit=limit).collect()
    assert len(found) == len(rows)
    by_id = {r["id"]: r["described"] for r in found}
    assert by_id[1] == ["zwei", "one", "zwei"] and by_id[2] is None and by_id[3] == [None]
    assert by_id[4] == [None, "one", None, None] and by_id[59] == ["one", "zwei"]
    none = described_list(df, "list", texts.limit(0), "described", limit=limit)
    assert none.where("id = 1").first()["described"] == [None, None, None]
