import pytest
from pyspark.sql import functions as F

from regispark.operators import joins
from regispark.operators.enrich import enrich
from regispark.operators.numbering import Chunks, row_numbers, row_range, rows_between, sorted_runs
from regispark.operators.prune import active_only, prune
from regispark.operators.sizing import (
    any_repeated,
    broadcast_if_small,
    heavy_keys,
    measured_bytes,
    split_by_keys,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def companies(spark):
    data = [(i, f"company {i}") for i in range(50)] + [(7, "company 7 again"), (None, "no key")]
    return spark.createDataFrame(data, "k int, name string")


@pytest.fixture(scope="module")
def establishments(spark):
    # Key 3 holds a third of the rows, key 7 doubles its company, 40 to 49 have none.
    data = [(3, "x") for _ in range(400)] + [(i % 40, str(i)) for i in range(800)]
    data += [(None, "lost"), (99, "orphan")]
    return spark.createDataFrame(data, "k int, e string")


def test_sizes(spark, companies):
    small, large = measured_bytes(companies, companies.unionByName(companies))
    assert small > 52 * 64
    assert large == 2 * small
    hinted = broadcast_if_small(companies, companies, limit=small)
    assert [few for _, few in hinted] == [True, True]
    assert broadcast_if_small(companies, limit=small - 1)[0][1] is False


def test_heavy_keys(spark, establishments):
    assert rows(heavy_keys(establishments, "k", min_rows=100)) == [(3, 420)]
    assert rows(heavy_keys(establishments, "k", min_rows=10_000)) == []
    assert rows(heavy_keys(establishments.limit(0), "k", min_rows=1)) == []
    some = spark.createDataFrame([(3,), (None,)], "k int")
    others, those = split_by_keys(establishments, some, "k")
    assert those.count() == 421
    assert others.count() == establishments.count() - 421
    pairs = heavy_keys(establishments, "k", "e", min_rows=20)
    assert rows(pairs) == [(3, "x", 400)]


def test_any_repeated(establishments):
    assert any_repeated(establishments.select("k")) is True
    assert any_repeated(establishments.select("k").distinct()) is False


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_left_join_with_a_hot_key(companies, establishments, hot_rows):
    want = companies.join(establishments, "k", "left")
    got = joins.company_establishment(companies, establishments, "k", hot_rows=hot_rows)
    assert rows(got) == rows(want)


def test_all_of_many_heavy_keys_are_found(spark):
    """1,200 keys with 100 to 102 rows among 40,000 with fewer; nulls heavy too."""
    hot = spark.range(1_200 * 100).select((F.col("id") % 1_200).alias("k"))
    more = spark.range(2 * 1_200).select((F.col("id") % 1_200).alias("k"))
    cold = spark.range(40_000 * 3).select((F.col("id") % 40_000 + 5_000).alias("k"))
    none = spark.range(150).select(F.lit(None).cast("bigint").alias("k"))
    df = hot.unionByName(more).unionByName(cold).unionByName(none)
    found = dict(heavy_keys(df, "k", min_rows=100).collect())
    assert found == {**{k: 102 for k in range(1_200)}, None: 150}
    some = df.where("k is null or k < 40 or k > 44000").withColumn("v", F.monotonically_increasing_id())
    numbered = row_numbers(some, "k", ["v"], "n", hot_rows=100)
    again = numbered.groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("m"), F.countDistinct("n").alias("d"))
    assert again.where("c <> m or c <> d").count() == 0
    assert again.count() == 1_040
    companies = df.distinct().withColumn("name", F.col("k").cast("string"))
    for limit in (0, 10**8):
        joined = joins.company_establishment(companies, df.withColumn("e", F.lit(1)), "k", limit=limit, hot_rows=100)
        assert joined.where("e is not null").count() == df.dropna().count()
        assert joined.where("e is null").count() == 1


@pytest.mark.parametrize("limit", [0, 10**6])
def test_hot_keys_are_spread(spark, companies, establishments, explain, limit):
    got = joins.company_establishment(companies, establishments, "k", limit=limit, hot_rows=100)
    plan = explain(got)
    assert ("_piece" in plan) == (limit == 0)
    assert rows(got) == rows(companies.join(establishments, "k", "left"))
    hot = heavy_keys(establishments, "k", min_rows=100)
    _, many = split_by_keys(establishments, hot, "k")
    pieces = F.pmod(F.xxhash64("_place"), F.lit(5))  # 420 rows in pieces of 100
    per_piece = joins.with_place(many, "_place").groupBy(pieces).count()
    assert per_piece.agg(F.max("count")).first()[0] <= 120


@pytest.mark.parametrize("limit", [0, 10**6])
def test_inner_join(companies, establishments, limit):
    want = companies.join(establishments, "k", "inner")
    got = joins.company_establishment(
        companies, establishments, "k", keep_unmatched=False, limit=limit
    )
    assert rows(got) == rows(want)


def test_null_rejecting_filter_makes_the_join_inner(companies, establishments, optimized):
    joined = joins.company_establishment(companies, establishments, "k")
    assert "Join Inner" in optimized(joined.where("e = 'x'"))


@pytest.mark.parametrize("limit", [0, 10**6])
def test_semi_join(companies, establishments, limit, explain):
    keys = joins.key_set(establishments, "k")
    got = joins.having_key(companies, keys, "k", limit)
    assert rows(got) == rows(companies.where("k < 40"))
    text = explain(got)
    assert ("BroadcastHashJoin" in text) == (limit > 0)
    assert ("SortMergeJoin" in text) == (limit == 0)


def test_skewed_semi_join_is_split_at_run_time(spark, tmp_path, explain):
    """A third of all rows under one key: AQE cuts its partition into several tasks."""
    left = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    left.repartition(8).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        keys = joins.key_set(left, "k")
        got = joins.having_key(left, keys, "k", limit=0)
        counted = got.agg(F.count("*").alias("n"), F.max("pad").alias("pad"))
        assert counted.collect()[0]["n"] == 300_000
        assert "skew=true" in explain(counted)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_prune(spark, companies, establishments):
    status = establishments.withColumn(
        "situacao_cadastral", F.expr("CASE WHEN e = 'lost' OR k < 5 THEN 2 WHEN k < 9 THEN 8 END")
    )
    active = active_only(status)
    assert active.where("k >= 5").count() == 0
    once = prune({"empresa": companies}, active, key="k")["empresa"]
    assert rows(once) == rows(companies.where("k < 5"))
    assert rows(prune({"empresa": once}, active, key="k")["empresa"]) == rows(once)


def test_active_without_special_situation(spark):
    df = spark.createDataFrame(
        [(2, None), (2, ""), (2, "x"), (4, None), (None, None)],
        "situacao_cadastral int, situacao_especial string",
    )
    assert active_only(df).count() == 3
    assert active_only(df, exclude_special=True).count() == 2


@pytest.mark.parametrize("limit", [0, 10**6])
def test_lookup(spark, limit):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "c int")
    codes = spark.createDataFrame(
        [(1, "one"), (2, "two"), (2, "deux"), (None, "null")], "codigo int, descricao string"
    )
    got = joins.lookups(df, [(codes, "c", "text")], limit=limit)
    assert rows(got) == [(1, "one"), (2, "deux"), (2, "two"), (3, None), (None, None)]


def test_enrich_pads_activity_codes(spark):
    df = spark.createDataFrame([(111301, 5)], "cnae_fiscal_principal int, municipio int")
    dictionaries = {
        "cnae": spark.createDataFrame([("0111301", "rice")], "codigo string, descricao string"),
        "munic": spark.createDataFrame([(5, "town")], "codigo int, descricao string"),
    }
    df = df.withColumn("pais", F.lit(None).cast("int"))
    got = enrich("estabelecimento", df, dictionaries).first()
    assert got["cnae_fiscal_principal_descricao"] == "rice"
    assert got["municipio_descricao"] == "town"


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_row_numbers(spark, establishments, hot_rows):
    got = row_numbers(establishments, "k", ["e"], "n", hot_rows=hot_rows)
    want = {}
    for k, e in rows(establishments):
        want.setdefault(k, []).append(e)
    found = {}
    for k, e, n in sorted((tuple(r) for r in got.collect()), key=lambda r: (repr(r[0]), r[2])):
        found.setdefault(k, []).append(e)
        assert n == len(found[k])
    assert found == {k: sorted(v) for k, v in want.items()}


def test_hot_copies_are_spread_when_sorted(spark):
    df = spark.range(1000).selectExpr("int(id * 0) AS k", "concat('same', k) AS e")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = sorted_runs(df, ["k", "e"], hot_rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = runs.groupBy(F.shiftright("_row", 33)).count().collect()
    assert len(parts) == 4
    assert max(r["count"] for r in parts) < 500
    got = row_numbers(df, "k", ["e"], "n", hot_rows=100)
    assert sorted(r.n for r in got.collect()) == list(range(1, 1001))


@pytest.mark.parametrize(
    ("skip", "take"), [(0, 3), (5, 0), (250, 500), (990, 100), (1000, 5), (0, 1000)]
)
def test_row_range(spark, skip, take):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), "id")
    got = [r.v for r in row_range(df, ["v"], skip, take).collect()]
    assert sorted(got) == list(range(skip, min(skip + take, 1000)))


@pytest.mark.parametrize("skip", [0, 240, 260, 600, 990])
def test_row_range_with_nulls_and_a_hot_value(spark, skip):
    lead = "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 3 = 0 THEN 500 ELSE id END AS v"
    df = spark.range(1000).selectExpr(lead, "id")
    order = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sorted(
        map(tuple, row_range(df, ["v", "id"], skip, 100).collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )
    assert got == order[skip : skip + 100]


def test_chunks_cover_everything_once(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("v"), "id")
    runs = sorted_runs(df, ["v", "id"])
    chunks = [rows_between(runs, skip, 30).collect() for skip in range(0, 120, 30)]
    assert [len(c) for c in chunks] == [30, 30, 30, 10]
    assert sorted(r["id"] for c in chunks for r in c) == list(range(100))


def test_whole_orders_are_joined(spark):
    from checks.join_queries import company_establishment_whole

    folder = "/root/testdata/sf0.001"
    keys = [r["o_orderkey"] for r in company_establishment_whole(spark, folder).select("o_orderkey").collect()]
    found = [k for k in keys if k is not None]
    assert len(found) == spark.read.parquet(f"{folder}/orders.parquet").count()
    assert len(keys) - len(found) >= spark.read.parquet(f"{folder}/customer.parquet").count() // 10


NAMES = ["Ana", "ana", "Álvaro", "", None, "Bruno", "Bruno ", "Çelik", "Zé"]


@pytest.mark.parametrize("skip", [0, 1, 37, 500, 950, 999, 1200])
def test_row_range_of_text_and_several_columns(spark, skip, monkeypatch):
    """A part of the rows is sorted and written, whatever the types of the order."""
    from regispark.operators import numbering

    sorted_sizes = []
    monkeypatch.setattr(
        numbering, "sorted_runs", lambda df, by: sorted_sizes.append(df.count()) or sorted_runs(df, by)
    )
    monkeypatch.setattr(numbering, "SAMPLED", 300)
    data = [(NAMES[i * 7 % 9], None if i % 11 == 0 else i * 31 % 50 / 4, i * 7919 % 1000, i % 2 == 0) for i in range(1000)]
    df = spark.createDataFrame(data, "name string, part double, id int, flag boolean").repartition(5)
    order = sorted(data, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    got = numbering.row_range(df, ["name", "part", "id"], skip, 10, small=40).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(order[skip : skip + 10], key=repr)
    assert sorted_sizes[0] <= 100


def test_row_range_of_alike_rows_ends(spark):
    df = spark.range(300).select(F.lit("same").alias("v"), "id")
    got = row_range(df, ["v"], 290, 100, small=5).collect()
    assert len(got) == 10
    assert row_range(df.limit(0), ["v"], 0, 10).collect() == []


def test_chunk_sizes_are_read_once(spark):
    chunks = Chunks(sorted_runs(spark.range(100).select(F.col("id").cast("string").alias("v")), ["v"]))
    chunks.runs.sparkSession.sparkContext.setJobGroup("chunks", "")
    parts = [chunks.rows(skip, 30) for skip in range(0, 120, 30)]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("chunks")) == []
    spark.sparkContext.setJobGroup("", "")
    assert [p.count() for p in parts] == [30, 30, 30, 10]
