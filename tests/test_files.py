import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from regispark.operators.prune import active_only
from regispark.plans.load import load_publication, read_publication
from regispark.plans.profile import company_profile, profile_inputs
from regispark.schemas import KEY, TABLES, code_links
from regispark.sinks import tables as sinks
from regispark.sources import archives
from regispark.sources.snapshots import at_snapshot
from regispark.sources.links import extract_links
from regispark.streaming.ingest import ingest, stream_files


def zipped(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, data in members.items():
            archive.writestr(name, data)


def test_archives(spark, tmp_path, monkeypatch):
    zipped(tmp_path / "a.zip", {"one.csv": b"1;x\n2;\xe9\r\n", "d/": b"", "d/two.csv": b"3;z"})
    zipped(tmp_path / "empty.zip", {"none.csv": b""})
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    (tmp_path / "other.txt").write_bytes(b"9;9\n")
    blocks = archives.expand_archives(spark, str(tmp_path))
    report = {(r.archive, r.member): (r["size"], r.error) for r in archives.archive_report(blocks).collect()}
    assert report["a.zip", "one.csv"] == (9, None)
    assert report["a.zip", "d/two.csv"] == (3, None)
    assert report["empty.zip", "none.csv"] == (0, None)
    assert report["bad.zip", None][1] is not None
    with pytest.raises(Exception, match="unreadable archive"):
        archives.scan_archives(spark, str(tmp_path), ["codigo", "descricao"]).collect()
    rows = archives.scan_archives(spark, str(tmp_path), ["codigo", "descricao"], on_error="quarantine")
    rows = rows.select("codigo", "descricao")
    assert sorted(map(tuple, rows.collect())) == [("1", "x"), ("2", "é"), ("3", "z")]


def test_a_damaged_member_gives_nothing_in_quarantine(spark, tmp_path):
    lines = "".join(f"{k};{os.urandom(40).hex()}\n" for k in range(4000)).encode()
    zipped(tmp_path / "a.zip", {"one.csv": lines, "two.csv": b"1;x\n"})
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[100_000:100_020] = b"\x00" * 20
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match="unreadable archive"):
        archives.scan_archives(spark, str(tmp_path), ["codigo", "descricao"]).collect()
    rows = archives.scan_archives(spark, str(tmp_path), ["codigo", "descricao"], on_error="quarantine")
    assert [tuple(r)[:2] for r in rows.collect()] == [("1", "x")]


def test_links_in_all_forms(spark):
    html = "<a href='a.zip'><A HREF = \"b.zip?x=1&amp;y=2\"><a class=c href=d.zip>"
    pages = spark.createDataFrame([(html, "http://h/p/")], "html string, url string")
    assert [r["link"] for r in extract_links(pages).collect()] == ["a.zip", "b.zip?x=1&y=2", "d.zip"]


def test_damaged_member_does_not_stop_the_others(spark, tmp_path):
    zipped(tmp_path / "a.zip", {"one.csv": os.urandom(5000).hex().encode(), "two.csv": b"1;x\n"})
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[200:220] = b"\x00" * 20
    (tmp_path / "a.zip").write_bytes(data)
    report = archives.archive_report(archives.expand_archives(spark, str(tmp_path))).collect()
    errors = {r.member: r.error for r in report}
    assert errors["one.csv"] is not None
    assert errors["two.csv"] is None


def test_blocks_hold_whole_lines(monkeypatch):
    monkeypatch.setattr(archives, "BLOCK_BYTES", 7)
    data = b"first\nsecond line\n\nlast"
    blocks = list(archives._whole_lines(io.BytesIO(data)))
    assert b"".join(blocks) == data
    assert len(blocks) > 2
    assert all(b.endswith(b"\n") for b in blocks[:-1])


def test_incremental_ingest(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    kinds = [("codigo", "int"), ("descricao", "text")]
    os.makedirs(source)

    def deliver(name, lines):
        with open(f"{source}/{name}", "wb") as out:
            out.write(lines)

    def run():
        stream = stream_files(spark, source, kinds, files_per_batch=2)
        query = ingest(stream, target, log)
        found = spark.read.parquet(target)
        return query, sorted((r.codigo, r.descricao) for r in found.collect())

    for i in range(5):
        deliver(f"{i}.csv", b"%d;\xe9\n" % i)
    query, rows = run()
    assert rows == [(i, "é") for i in range(5)]
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert run()[1] == rows
    deliver("5.csv", b"5;\n")
    assert run()[1] == [*rows, (5, None)]


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_replace_append_drop(spark, database):
    name = f"{database}.t"
    sinks.replace_table(spark.range(3), name)
    sinks.replace_table(spark.table(name).where("id > 0"), name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2]
    sinks.append_table(spark.range(2), name)
    assert spark.table(name).count() == 4
    sinks.analyze(spark, name)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert "4 rows" in described["Statistics"]
    sinks.drop_tables(spark, name, f"{database}.absent")
    assert not spark.catalog.tableExists(name)


def test_bucketed_semi_join_needs_no_shuffle(spark, database, explain):
    rows = spark.range(1000).select((F.col("id") % 100).cast("string").alias(KEY), "id")
    keys = rows.where("id < 50").select(KEY).distinct()
    sinks.write_bucketed(rows, f"{database}.socios", KEY, 4)
    sinks.write_bucketed(keys, f"{database}.active", KEY, 4)
    right = spark.table(f"{database}.active").hint("merge")
    joined = spark.table(f"{database}.socios").join(right, KEY, "left_semi")
    assert joined.count() == 500
    assert "Exchange" not in explain(joined)
    with pytest.raises(ValueError, match="10 rows"):
        sinks.write_bucketed(rows, f"{database}.hot", KEY, 4, hot_rows=10)
    assert not spark.catalog.tableExists(f"{database}.hot")


def test_indexed_table_has_bloom_filters(spark, database, tmp_path):
    rows = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias(KEY), "id")
    sinks.write_indexed(rows.coalesce(1), f"{database}.empresa", KEY)
    import pyarrow.parquet as pq

    (file,) = [p for p in (tmp_path / "db" / "empresa").iterdir() if p.name.endswith(".parquet")]
    plain = tmp_path / "plain"
    rows.coalesce(1).write.parquet(str(plain))
    (other,) = [p for p in plain.iterdir() if p.name.endswith(".parquet")]
    assert pq.ParquetFile(file).metadata.num_rows == 1000
    assert file.stat().st_size > other.stat().st_size + 1000
    key = rows.where("id = 7").first()[KEY]
    assert spark.table(f"{database}.empresa").where(F.col(KEY) == key).first()["id"] == 7


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_clustered(spark, tmp_path, hot_rows):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 5).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        written = sinks.clustered(rows, "k", hot_rows=hot_rows)
        written.write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r.k for r in read.collect()) == sorted(r.k for r in rows.collect())
    files = read.where("k = 5").groupBy(F.input_file_name()).count().collect()
    assert (len(files) > 1) == (hot_rows == 100)


def test_snapshots_are_pruned(spark, tmp_path, explain):
    root = str(tmp_path / "t")
    for month, n in (("2025-08", 2), ("2025-09", 3), ("2025-09", 5)):
        sinks.write_snapshot(spark.range(n), root, month)
    one = at_snapshot(spark.read.parquet(root), "2025-09")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(snapshot" in explain(one)


def test_database_writer_options(spark, monkeypatch):
    """No database is started: only what would be asked of the driver is looked at."""
    seen = {}

    class Writer:
        def format(self, kind):
            seen["format"] = kind
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def save(self):
            seen["saved"] = True

    df = spark.range(1)
    monkeypatch.setattr(type(df), "write", property(lambda self: Writer()))
    sinks.write_database(df, "jdbc:x:y", "empresa", user="u")
    assert seen == {
        "format": "jdbc",
        "mode": "append",
        "url": "jdbc:x:y",
        "dbtable": "empresa",
        "batchsize": 4096,
        "numPartitions": 16,
        "user": "u",
        "saved": True,
    }


def publication(folder):
    """A small publication: ten files, cleaned as little as the real ones."""

    def line(table, **values):
        return ";".join(f'"{values.get(n, "")}"' for n in TABLES[table].names) + "\r\n"

    def establishment(basico, status, **more):
        return line(
            "estabelecimento",
            cnpj_basico=basico,
            cnpj_ordem="0001",
            cnpj_dv="91",
            situacao_cadastral=status,
            data_situacao_cadastral="20200131",
            cnae_fiscal_principal="0111301",
            municipio="7107",
            **more,
        )

    files = {
        "K1.EMPRECSV": line("empresa", cnpj_basico="00000001", razao_social="Água \x00Ltda", capital_social="1000,50")
        + line("empresa", cnpj_basico="00000002", razao_social="INATIVA")
        + line("empresa", cnpj_basico="00000003", razao_social="SEM ESTABELECIMENTO"),
        "K2.EMPRECSV": line("empresa", cnpj_basico="00000004", razao_social="€ DUPLA"),
        "K.ESTABELE": establishment("00000001", "02", cnae_fiscal_secundaria="0111301,9999999")
        + establishment("00000002", "08")
        + establishment("00000004", "02")
        + establishment("00000004", "02", situacao_especial="X")
        + establishment("00000005", ""),
        "K.SOCIOCSV": line("socios", cnpj_basico="00000001", nome_socio_razao_social="A")
        + line("socios", cnpj_basico="00000001", nome_socio_razao_social="B")
        + line("socios", cnpj_basico="00000002", nome_socio_razao_social="C"),
        "F.SIMPLES.CSV": line("simples", cnpj_basico="00000004", opcao_mei="N", data_opcao_mei="00000000"),
        "F.CNAECSV": line("cnae", codigo="0111301", descricao="Cultivo de arroz"),
        "F.MOTICSV": line("moti", codigo="00", descricao="SEM MOTIVO"),
        "F.MUNICCSV": line("munic", codigo="7107", descricao="SAO PAULO"),
        "F.NATJUCSV": line("natju", codigo="2062", descricao="Limitada"),
        "F.PAISCSV": line("pais", codigo="105", descricao="BRASIL"),
        "F.QUALSCSV": line("quals", codigo="05", descricao="Administrador"),
        "F.EMPRE.tmp.csv": "rubbish",
    }
    for name, text in files.items():
        (folder / name).write_bytes(text.encode("cp1252"))


def test_load(spark, tmp_path, database):
    folder = tmp_path / "files"
    folder.mkdir()
    publication(folder)
    for _ in range(2):  # a second load replaces the first
        loaded = load_publication(spark, str(folder), database)
    counts = {name: df.count() for name, df in loaded.items()}
    assert counts == {
        "empresa": 2,
        "estabelecimento": 3,
        "socios": 2,
        "simples": 1,
        "cnae": 1,
        "moti": 1,
        "munic": 1,
        "natju": 1,
        "pais": 1,
        "quals": 1,
    }
    names = {r.razao_social for r in loaded["empresa"].collect()}
    assert names == {"Água Ltda", "€ DUPLA"}
    assert {r.cnpj for r in loaded["estabelecimento"].collect()} == {"00000001000191", "00000004000191"}
    leftovers = [t.name for t in spark.catalog.listTables(database) if "__" in t.name]
    assert leftovers == []

    profile = company_profile(**profile_inputs(loaded, "2025-09")).collect()
    first = {r.cnpj: r for r in profile}["00000001000191"]
    assert first.descricao_atividade_principal == "Cultivo de arroz"
    assert first.nome_municipio == "SAO PAULO"
    assert (first.cnae_secundario_1, first.descricao_atividade_secundaria_1) == (
        "0111301",
        "Cultivo de arroz",
    )
    assert (first.cnae_secundario_2, first.descricao_atividade_secundaria_2) == ("9999999", None)


def test_load_from_archives(spark, tmp_path, database):
    folder = tmp_path / "files"
    folder.mkdir()
    publication(folder)
    zips = tmp_path / "zips"
    zips.mkdir()
    for file in folder.iterdir():
        if not file.name.endswith(".tmp.csv"):
            zipped(zips / f"{file.name}.zip", {file.name: file.read_bytes()})
    loaded = load_publication(spark, str(zips), database, archived=True)
    assert loaded["empresa"].count() == 2
    assert {r.cnpj for r in loaded["estabelecimento"].collect()} == {"00000001000191", "00000004000191"}
    assert {r.razao_social for r in loaded["empresa"].collect()} == {"Água Ltda", "€ DUPLA"}


def test_load_options(spark, tmp_path, database):
    folder = tmp_path / "files"
    folder.mkdir()
    publication(folder)
    whole = load_publication(spark, str(folder), database, active=False)
    assert (whole["empresa"].count(), whole["estabelecimento"].count()) == (4, 5)
    strict = load_publication(spark, str(folder), database, exclude_special=True)
    assert strict["estabelecimento"].count() == 2
    (folder / "Z.PAISCSV").write_bytes(b'"x";"bad code"\n"1";"a";"b"\n')
    with pytest.raises(Exception, match="not a valid int|MALFORMED|Malformed"):
        load_publication(spark, str(folder), database)
    assert spark.table(f"{database}.pais").count() == 1  # the old tables are still there
    loaded = load_publication(spark, str(folder), database, on_error="quarantine")
    assert loaded["pais"].count() == 2
    assert spark.table(f"{database}.pais__rejects").count() == 2


def test_reading_runs_nothing_and_links_exist(spark, tmp_path):
    publication(tmp_path)
    tables = read_publication(spark, str(tmp_path))
    assert set(tables) == set(TABLES)
    assert active_only(tables["estabelecimento"]).count() == 3
    for name in ("empresa", "estabelecimento", "socios"):
        for link in code_links(name):
            assert link.column in tables[name].columns
            assert link.target_column in tables[link.target].columns


def zip_of(path, **members):
    import zipfile

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


def test_archive_source_plans_a_partition_per_member(spark, tmp_path):
    from regispark.sources.archive_source import NAME, register

    register(spark)
    zip_of(tmp_path / "a.zip", CNAE1="1;x\n2;y\n", OTHER="3;z\n", CNAE2="4;v\n")
    (tmp_path / "b.ZIP").write_bytes(b"no archive")
    (tmp_path / "c.txt").write_text("no")
    blocks = spark.read.format(NAME).option("containing", "CNAE").load(str(tmp_path))
    assert blocks.rdd.getNumPartitions() == 3  # two members, and one archive that cannot be read
    rows = {(r["archive"], r["member"]): r["data"] for r in blocks.collect()}
    assert rows == {("a.zip", "CNAE1"): b"1;x\n2;y\n", ("a.zip", "CNAE2"): b"4;v\n", ("b.ZIP", None): None}
    assert blocks.where("error is not null").first()["member"] is None
    empty = tmp_path / "empty"
    empty.mkdir()
    assert spark.read.format(NAME).load(str(empty)).collect() == []


def test_archive_stream_takes_new_and_changed_archives_once(spark, tmp_path):
    from regispark.sources.archive_source import NAME, register
    from regispark.streaming.ingest import ingest

    register(spark)
    source, target, log = (tmp_path / n for n in ("in", "out", "log"))
    source.mkdir()

    def told():
        stream = spark.readStream.format(NAME).load(str(source)).where("data is not null")
        stream = stream.selectExpr("archive", "member", "decode(data, 'UTF-8') as text")
        ingest(stream, str(target), str(log))
        return sorted(tuple(r) for r in spark.read.parquet(str(target)).collect())

    zip_of(source / "a.zip", one="1\n")
    first = [("a.zip", "one", "1\n")]
    assert told() == first
    assert told() == first
    zip_of(source / "b.zip", two="2\n")
    zip_of(source / "a.zip", one="changed\n")
    assert told() == sorted([*first, ("a.zip", "one", "changed\n"), ("b.zip", "two", "2\n")])
