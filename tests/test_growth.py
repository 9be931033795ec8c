"""Work that must not grow faster than the rows: batches of files, parts of sorts, large dictionaries."""

import os
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import scan_queries
from checks.compare import difference
from regispark.operators import numbering
from regispark.operators.enrich import described_list
from regispark.operators.joins import lookups
from regispark.plans import profile
from regispark.schemas import TABLES
from regispark.sinks import layout
from regispark.streaming.files import FileIngest


def test_batches_read_the_state_once(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(12):
        (source / f"f{k:02d}").write_text(f"{k};x{k}\n")
    read, plain = [], FileIngest.batches
    monkeypatch.setattr(FileIngest, "batches", lambda self: read.append(1) or plain(self))
    loading = FileIngest(spark, str(source), str(tmp_path / "out"), TABLES["munic"], files_per_batch=2)
    assert loading.run() == 6
    assert len(read) <= 3
    (source / "f00").write_text("0;again\n")
    assert loading.run() == 1
    found = {r["codigo"]: r["descricao"] for r in loading.rows().collect()}
    assert found == {k: f"x{k}" if k else "again" for k in range(12)}
    assert sorted(loading.batches()) == list(range(7))


def test_a_task_writes_one_file_of_many_batches(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        lines = spark.range(95, numPartitions=2).select(F.expr("string(id)").alias("line"))
        scan_queries._put_lines(lines, str(tmp_path / "text"), "a.csv")
        named = lines.select(F.lit("M").alias("member"), F.lit("n").alias("name"), "line")
        scan_queries._zipped(named, str(tmp_path / "zips"))
    finally:
        spark.conf.set(name, before)
    assert len(os.listdir(tmp_path / "text")) == len(os.listdir(tmp_path / "zips")) == 2
    assert spark.read.text(str(tmp_path / "text")).distinct().count() == 95
    zipped = scan_queries.scan_archives(spark, str(tmp_path / "zips"), ["x"])
    assert sorted(int(r["x"]) for r in zipped.collect()) == list(range(95))


def test_tasks_without_rows_write_no_text_file(spark, tmp_path):
    lines = spark.range(8, numPartitions=4).where("id < 2").select(F.expr("string(id)").alias("line"))
    scan_queries._put_lines(lines, str(tmp_path / "text"), "a.csv")
    assert len(os.listdir(tmp_path / "text")) == 1
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "text")).collect()) == ["0", "1"]


def test_tasks_without_rows_write_no_archive(spark, tmp_path):
    lines = spark.range(8, numPartitions=4).where("id < 2").select(F.expr("string(id)").alias("line"))
    scan_queries._zipped(lines.select(F.lit("M").alias("member"), F.lit("n").alias("name"), "line"), str(tmp_path / "zips"))
    assert len(os.listdir(tmp_path / "zips")) == 1
    zipped = scan_queries.scan_archives(spark, str(tmp_path / "zips"), ["x"])
    assert sorted(r["x"] for r in zipped.collect()) == ["0", "1"]


def test_a_member_without_records(spark, tmp_path):
    for name, data in (("a", ""), ("b", "1\n")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr("one.csv", data)
    read = scan_queries.scan_archives(spark, str(tmp_path), ["x"], multiline=True)
    assert [r["x"] for r in read.collect()] == ["1"]


def test_codes_of_more_digits_stay_different(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    for name, key in (("supplier", "s_suppkey"), ("lineitem", "l_suppkey"), ("region", None)):
        rows = spark.read.parquet(f"{small}/{name}.parquet")
        rows = rows.withColumn(key, F.col(key) + 9_995) if key else rows
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("supplier", "lineitem", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    problem, rows, _ = difference(spark, con, "enriched_partners", str(tmp_path))
    assert problem is None and rows == spark.read.parquet(f"{small}/lineitem.parquet").count()


def test_parts_of_hot_keys_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(numbering, "FEW_PARTS", 4, raising=False)
    monkeypatch.setattr(numbering, "PART_ROWS", 200, raising=False)
    asked, plain = [], numbering._sorted
    monkeypatch.setattr(numbering, "_sorted", lambda df, by, parts=None: asked.append(parts) or plain(df, by, parts))
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.expr("id * 7919 % 1000").alias("v"))
    found = numbering.row_numbers(rows, "k", ["v"], "number", hot_rows=10).collect()
    assert asked == [5]
    for key in (0, 1):
        own = sorted((r["v"], r["number"]) for r in found if r["k"] == key)
        assert [number for _, number in own] == list(range(1, len(own) + 1))


def test_small_files_are_cut_from_fewer_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "FEW_PARTS", 3, raising=False)
    monkeypatch.setattr(layout, "PART_ROWS", 1000, raising=False)
    asked, plain = [], layout.clustered
    monkeypatch.setattr(layout, "clustered", lambda *args, files, **more: asked.append(files) or plain(*args, files=files, **more))
    rows = spark.range(2000).select(F.expr("id * 7919 % 2000").alias("key"), "id")
    path = str(tmp_path / "table")
    layout.write_clustered(rows, path, ["key"], rows_per_file=50)
    assert asked == [3]
    read = spark.read.parquet(path)
    directory = layout.file_directory(read, ["key"])
    files = directory.collect()
    assert len(files) >= 40 and max(r["rows"] for r in files) <= 50
    assert len(layout.files_with(directory, "key", [1234])) == 1
    assert layout.lookup(spark, directory, read, "key", [1234]).count() == 1 and read.distinct().count() == 2000


@pytest.fixture
def dictionary(spark):
    """4,000 codes; rows have few of them, unknown ones and NULL."""
    return spark.range(4000).select(F.expr("string(id)").alias("codigo"), F.expr("'text ' || id").alias("descricao"))


#: Between the size of the codes that rows have and that of the dictionary.
LIMIT = 20_000


def test_large_dictionaries_are_cut_to_the_codes_in_use(spark, dictionary):
    rows = spark.createDataFrame([(1, "7", "7,9,zz"), (2, None, None), (3, "zz", ""), (4, "3999", "3999")], "id int, code string, list string")
    found = lookups(rows, [(dictionary, "code", "text")], limit=LIMIT)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["text"] for r in found.collect()} == {1: "text 7", 2: None, 3: None, 4: "text 3999"}
    listed = described_list(rows, "list", dictionary, "texts", limit=LIMIT)
    assert "Join" not in listed._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["texts"] for r in listed.collect()} == {1: ["text 7", "text 9", None], 2: None, 3: [None], 4: ["text 3999"]}


def test_profile_with_a_large_dictionary(spark, dictionary, monkeypatch):
    companies = spark.createDataFrame([(1, "A", "d"), (2, "B", "d")], "cnpj_basico int, razao_social string, data string")
    rows = [(10, 1, "U", 1, "7", "9,zz,3999", "d"), (11, 1, "U", 2, None, None, "d"), (12, 2, "V", 1, "8", "", "d"), (None, 2, "V", 9, "9", "1," * 12 + "2", "d")]
    establishments = spark.createDataFrame(
        rows, "cnpj int, cnpj_basico int, sigla_uf string, id_municipio int, cnae_fiscal_principal string, "
        "cnae_fiscal_secundaria string, data string",
    )
    activities = dictionary.withColumnRenamed("codigo", "cnae_2_3_subclasses")
    cities = spark.createDataFrame([(1, "one"), (2, "two")], "id_municipio int, nome string")
    several = [
        sorted(map(tuple, profile.company_profile(companies, establishments, activities, cities, limit=limit).collect()), key=repr)
        for limit in (0, 10**7)
    ]
    assert several[0] == several[1] and len(several[0]) == 4
    assert next(r for r in several[0] if r[0] == 10)[7:13] == ("9", "text 9", "zz", None, "3999", "text 3999")

    def refused(*args):
        raise AssertionError("rows are unnested for a dictionary of which few codes are in use")

    monkeypatch.setattr(profile, "_unnested", refused)
    found = profile.company_profile(companies, establishments, activities, cities, limit=LIMIT)
    assert sorted(map(tuple, found.collect()), key=repr) == several[0]
