import pytest

import __spark_entry__ as entry
from checks.compare import database, difference
from checks.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    problem, _, _ = difference(spark, con, name, FOLDER)
    assert problem is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "cnpj" and df.count() == 1500
