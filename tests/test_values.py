import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regispark.functions import codepage, codes, values
from regispark.operators.typing import split_rejected, type_table, typed
from regispark.schemas import TABLES, text_schema


def one(spark, raw, column):
    df = spark.createDataFrame([(raw,)], "x string")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("20230101", datetime.date(2023, 1, 1)),
        ("00000000", None),
        ("", None),
        (None, None),
        ("0", None),
        ("2023-01-01", None),
        ("20230101\n", None),
        ("２０２３０１０１", None),
    ],
)
def test_date(spark, raw, want):
    assert one(spark, raw, values.date) == want


@pytest.mark.parametrize("raw", ["20230231", "00000101", "20231301"])
def test_impossible_date(spark, raw):
    with pytest.raises(Exception, match="not a valid date"):
        one(spark, raw, values.date)
    assert one(spark, raw, lambda c: values.date(c, values.NULL)) is None
    assert one(spark, raw, lambda c: values.is_rejected(c, "date")) is True


@pytest.mark.parametrize(
    ("raw", "want"), [("05", 5), (" 12 ", 12), ("+7", 7), ("-3", -3), ("", None), (None, None)]
)
def test_int(spark, raw, want):
    assert one(spark, raw, values.integer) == want


@pytest.mark.parametrize("raw", ["12.5", "99999999999", "x", "1e3"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_int(spark, raw, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        if raw == "12.5" and ansi == "false":
            return  # a session without ANSI reads the whole part
        with pytest.raises(Exception, match="not a valid int"):
            one(spark, raw, values.integer)
        assert one(spark, raw, lambda c: values.integer(c, values.NULL)) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("1234,565", "1234.57"),
        ("0,00", "0.00"),
        ("1e3", "1000.00"),
        ("-1,005", "-1.01"),
        ("", None),
        (None, None),
    ],
)
def test_decimal(spark, raw, want):
    assert one(spark, raw, values.decimal) == (None if want is None else Decimal(want))


@pytest.mark.parametrize("raw", ["1.234,56", "NaN", "x", "12345678901234567"])
def test_bad_decimal(spark, raw):
    with pytest.raises(Exception, match="not a valid decimal"):
        one(spark, raw, values.decimal)
    assert one(spark, raw, lambda c: values.is_rejected(c, "numeric(18,2)")) is True


@pytest.mark.parametrize(
    ("raw", "want"),
    [("123456789", "12345678"), ("12", "12"), ("12  ", "12"), ("", None), (None, None)],
)
def test_char(spark, raw, want):
    assert one(spark, raw, lambda c: values.char(c, 8)) == want


def test_full_key(spark):
    df = spark.createDataFrame([("1", "2", "3"), ("1", None, "3")], "a string, b string, c string")
    keys = df.select(values.full_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).collect()
    assert [r.k for r in keys] == ["123", None]


def test_padded_code(spark):
    df = spark.createDataFrame([(111301,), (1113019,), (11130199,), (None,)], "x int")
    got = [r[0] for r in df.select(values.padded_code(F.col("x"), 7)).collect()]
    assert got == ["0111301", "1113019", "11130199", None]


def test_cp1252(spark):
    raw = bytes(range(256))
    df = spark.createDataFrame([(bytearray(raw),), (None,)], "x binary")
    got = [r[0] for r in df.select(codepage.cp1252(F.col("x"))).collect()]
    assert got == [raw.decode("cp1252", errors="replace"), None]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, [(1, None)]),
        ("", [(1, "")]),
        ("a", [(1, "a")]),
        ("a,,b ", [(1, "a"), (2, ""), (3, "b ")]),
        ("a,", [(1, "a"), (2, "")]),
        ("a,a", [(1, "a"), (2, "a")]),
    ],
)
def test_unnest(spark, raw, want):
    df = spark.createDataFrame([(7, raw)], "id int, list string")
    rows = df.withColumn("list", codes.split_codes(F.col("list")))
    got = [(r.slot, r.code) for r in codes.unnest_codes(rows, "list").collect()]
    assert sorted(got) == want


def test_quarantine_keeps_rows_and_reasons(spark):
    raw = spark.createDataFrame(
        [("1", "2,5", "20230101"), ("x", "1.2,3", "20230231"), ("", "", "")],
        "a string, b string, c string",
    )
    kinds = [("a", "int"), ("b", "numeric(18,2)"), ("c", "date")]
    good, rejects = split_rejected(typed(raw, kinds, on_error="quarantine"))
    assert good.count() == 3
    (bad,) = rejects.collect()
    assert [(r.column, r.value) for r in bad["_rejected"]] == [
        ("a", "x"),
        ("b", "1.2,3"),
        ("c", "20230231"),
    ]


def test_fail_is_raised_when_the_table_is_written(spark, tmp_path):
    raw = spark.createDataFrame([("x", "d")], text_schema(["codigo", "descricao"]))
    rows = type_table(raw, TABLES["pais"])
    with pytest.raises(Exception, match="not a valid int: x"):
        rows.write.parquet(str(tmp_path / "t"))


ROWS = st.lists(
    st.tuples(
        st.integers(-(2**31), 2**31 - 1) | st.none(),
        st.decimals(
            min_value=-(10**15), max_value=10**15, places=2, allow_nan=False, allow_infinity=False
        )
        | st.none(),
        st.dates(min_value=datetime.date(1, 1, 1)) | st.none(),
    ),
    min_size=1,
    max_size=20,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=ROWS)
def test_typing_a_rendering_is_identity(spark, rows):
    text = [
        (
            "" if i is None else str(i),
            "" if d is None else str(d).replace(".", ","),
            "" if t is None else t.strftime("%Y%m%d").zfill(8),
        )
        for i, d, t in rows
    ]
    raw = spark.createDataFrame(text, "i string, d string, t string")
    got = typed(raw, [("i", "int"), ("d", "numeric(18,2)"), ("t", "date")]).collect()
    assert [tuple(r) for r in got] == rows
