import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from regispark.operators.pivot import pivot_slots
from regispark.plans.profile import KEYS, company_profile, profile_columns

DAY = datetime.date(2023, 5, 18)
OTHER = datetime.date(2023, 4, 18)

COMPANIES = "cnpj_basico string, razao_social string, data date"
ESTABLISHMENTS = (
    "cnpj string, cnpj_basico string, sigla_uf string, id_municipio string, "
    "cnae_fiscal_principal string, cnae_fiscal_secundaria string, data date"
)
ACTIVITIES = "cnae_2_3_subclasses string, descricao string"
CITIES = "id_municipio string, nome string"


def expected(companies, establishments, activities, cities, snapshot, prefix, slots):
    """The same query row by row in plain Python."""
    joined = []
    for (basico, name, day), est in itertools.product(companies, establishments):
        if basico is None or basico != est[1] or (snapshot and (day, est[6]) != (snapshot,) * 2):
            continue
        if not name.startswith(prefix or ""):
            continue
        mains = [d for c, d in activities if c is not None and c == est[4]] or [None]
        towns = [n for c, n in cities if c is not None and c == est[3]] or [None]
        for main, town in itertools.product(mains, towns):
            joined.append((est[0], name, est[2], est[3], town, est[4], main, day, est[5]))

    def key(row):
        return [(v is not None, str(v)) for v in row]

    groups, used = {}, {}
    for row in sorted(joined, key=key):
        cells = groups.setdefault(row[:8], {})
        for code in [None] if row[8] is None else row[8].split(","):
            slot = used[row[0]] = used.get(row[0], 0) + 1
            texts = [d for c, d in activities if c is not None and c == code and d is not None]
            cells[slot] = (code, max(texts) if texts else None)
    out = []
    for row, cells in groups.items():
        pairs = [v for i in range(1, slots + 1) for v in cells.get(i, (None, None))]
        out.append((*row[:7], *pairs, row[7]))
    return sorted(out, key=repr)


def frames(spark, companies, establishments, activities, cities):
    return (
        spark.createDataFrame(companies, COMPANIES),
        spark.createDataFrame(establishments, ESTABLISHMENTS),
        spark.createDataFrame(activities, ACTIVITIES),
        spark.createDataFrame(cities, CITIES),
    )


def made(seed, repeat_keys, repeat_companies, repeat_codes):
    rnd = random.Random(seed)
    companies = [(f"b{i}", f"{'CO' if i % 2 else 'XO'}{i}", DAY) for i in range(12)]
    companies += [(f"b{i}", f"CO{i}", OTHER) for i in range(6)] + [("none", "CONE", DAY)]
    if repeat_companies:
        companies += [("b1", "CO1 again", DAY), ("b3", "CO3", DAY)]
    activities = [(str(c), f"act {c}") for c in range(8)] + [("", "empty"), (None, "null")]
    if repeat_codes:
        activities += [("3", "act 3 b"), ("5", "a")]
    cities = [(str(c), f"city {c}") for c in range(4)]
    if repeat_codes:
        cities.append(("2", "city two"))

    def some_list():
        n = rnd.choice([0, 1, 2, 10, 11, 13])
        if n == 0:
            return rnd.choice([None, ""])
        return ",".join(str(rnd.randrange(10)) for _ in range(n))

    establishments = []
    for i in range(60):
        est = (
            None if i % 17 == 0 else f"c{i}",
            f"b{rnd.randrange(13)}",
            rnd.choice(["SP", None]),
            rnd.choice(["0", "1", "2", "9", None]),
            rnd.choice(["1", "3", "77", None]),
            some_list(),
            DAY if i % 5 else OTHER,
        )
        establishments.append(est)
        if repeat_keys and i % 6 == 0:
            establishments.append(est)
            establishments.append((*est[:5], some_list(), est[6]))
            establishments.append((*est[:2], "RJ", *est[3:]))
    if not repeat_keys:  # one NULL key at most
        nulls = [e for e in establishments if e[0] is None]
        establishments = [e for e in establishments if e not in nulls[1:]]
    return companies, establishments, activities, cities


@pytest.mark.parametrize("limit", [0, 10**7])
@pytest.mark.parametrize(
    "repeats", [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (1, 1, 1)], ids=str
)
def test_against_row_by_row(spark, repeats, limit):
    data = made(5, *repeats)
    got = company_profile(*frames(spark, *data), snapshot=DAY, prefix="CO", limit=limit)
    assert got.columns == profile_columns()
    assert len(got.columns) == 28
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(
        *data, DAY, "CO", 10
    )


@pytest.mark.parametrize("slots", [1, 3])
def test_other_number_of_slots(spark, slots):
    data = made(8, 1, 0, 0)
    got = company_profile(*frames(spark, *data), snapshot=DAY, slots=slots)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(
        *data, DAY, None, slots
    )


def test_hot_key(spark):
    """Copies of one establishment make a third of all rows; every list item still counts."""
    companies = [(f"b{i}", f"CO{i}", DAY) for i in range(5)]
    hot = [("hot", "b1", "SP", "1", "1", "1,2", DAY)] * 300
    hot += [("hot", "b1", uf, "1", "1", "3", DAY) for uf in "ABCDEFGHIJKLMNOP"]
    other = [(f"c{i}", f"b{i % 5}", "SP", "1", "1", "4,5,6", DAY) for i in range(600)]
    data = (companies, hot + other, [("1", "one"), ("3", "three")], [("1", "town")])
    got = company_profile(*frames(spark, *data), snapshot=DAY)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(
        *data, DAY, None, 10
    )


def test_rank_filter_is_applied_before_the_shuffle(spark, explain):
    data = made(5, 1, 0, 0)
    text = explain(company_profile(*frames(spark, *data), snapshot=DAY))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text


def test_normal_data_is_neither_shuffled_nor_grouped(spark, tmp_path, explain):
    for name, df in zip("ceat", frames(spark, *made(5, 0, 0, 0))):
        path = str(tmp_path / name)
        if name in "ce":
            df.write.partitionBy("data").parquet(path)
        else:
            df.write.parquet(path)
    inputs = [spark.read.parquet(str(tmp_path / name)) for name in "ceat"]
    text = explain(company_profile(*inputs, snapshot=DAY, prefix="CO"))
    assert "Exchange hashpartitioning" not in text
    assert "Aggregate" not in text and "Window" not in text
    assert "PartitionFilters: [isnotnull(data" in text
    assert "StringStartsWith(razao_social,CO)" in text


def test_pivot_then_unpivot_gives_the_first_codes(spark):
    items = [("a", i + 1, f"x{i}") for i in range(13)] + [("b", 1, None), (None, 2, "n")]
    df = spark.createDataFrame(items, "k string, slot int, code string")
    wide = pivot_slots(df, ["k"], ["code"], "slot", 10)
    stack = ", ".join(f"{i}, code_{i}" for i in range(1, 11))
    back = wide.selectExpr("k", f"stack(10, {stack}) AS (slot, code)").where("code IS NOT NULL")
    want = df.where("slot <= 10 AND code IS NOT NULL")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr
    )
    assert wide.count() == 3


def test_null_keys_group_together(spark):
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 2, "b")], "k string, slot int, code string"
    )
    assert pivot_slots(df, ["k"], ["code"], "slot", 2).collect() == [(None, "a", "b")]


def test_distinct_under_max_is_one_aggregation(spark, optimized):
    df = spark.createDataFrame([("a", "b")], "k string, v string")
    text = optimized(df.distinct().groupBy("k").agg(F.max("v")))
    assert text.count("Aggregate") == 1


def test_keys_are_in_published_order():
    assert KEYS[0] == "cnpj" and KEYS[-1] == "data_info"
    assert profile_columns(2)[7:11] == [
        "cnae_secundario_1",
        "descricao_atividade_secundaria_1",
        "cnae_secundario_2",
        "descricao_atividade_secundaria_2",
    ]


def test_a_repeated_code_touches_its_own_rows_only(spark, explain):
    from regispark.plans import profile

    companies, establishments, activities, cities = frames(spark, *made(5, False, False, True))
    rows = establishments.withColumn("razao_social", F.lit("x"))
    activity, city = activities.toDF("_activity", "_text"), cities.toDF("_city", "_name")
    alone, doubled = profile._without_doubled(rows, activity, city, 10**6)
    touched = F.col("cnae_fiscal_principal").isin("3", "5") | (F.col("id_municipio") == "2")
    assert doubled.count() == rows.where(touched).count() > 0
    assert alone.count() == rows.count() - doubled.count() > 0
    assert "Exchange hashpartitioning" not in explain(alone)
