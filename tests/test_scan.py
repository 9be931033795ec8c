import pytest
from pyspark.sql import functions as F

from regispark.schemas import TABLES, text_schema
from regispark.sinks.tables import write_delimited
from regispark.sources.delimited import NA_TOKENS, scan, scan_table, split_corrupt
from regispark.sources.files import is_archive, list_files, manifest_diff, route_files
from regispark.sources.links import extract_links

NAMES = ["a", "b", "c"]


def write(tmp_path, data, name="x.csv"):
    (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def read(spark, path, names=NAMES, **options):
    rows = scan(spark, path, names, **options)
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        (b'"1";"x";"y"', ("1", "x", "y")),
        (b"1;x;y", ("1", "x", "y")),
        (b'1;"say ""hi""";y', ("1", 'say "hi"', "y")),
        (b'1;"a;b";y', ("1", "a;b", "y")),
        (b'1;"c:\\";y', ("1", "c:\\", "y")),
        (b'1;;""', ("1", None, "")),
        (b"1;x;y\r", ("1", "x", "y")),
        (b'"1";"x";"y"\r', ("1", "x", "y")),
        (b"\x80;\x93;\xe9", ("€", "“", "é")),
        (b"\x81;x;y", ("�", "x", "y")),
        (b"a\x00b;x;y", ("ab", "x", "y")),
        (b'1;\x00"a;b";y', ("1", "a;b", "y")),
        (b"1; x ;y", ("1", " x ", "y")),
    ],
)
def test_line(spark, tmp_path, line, want):
    assert read(spark, write(tmp_path, line + b"\n\n")) == [want]


def test_blank_lines_are_skipped(spark, tmp_path):
    path = write(tmp_path, b"\n1;x;y\n  \r\n\x00\x00\n\r\n2;;\n;;\n")
    assert read(spark, path) == [("1", "x", "y"), ("2", None, None), (None, None, None)]


def test_files_are_unioned_with_duplicates(spark, tmp_path):
    write(tmp_path, b"1;x;y\n1;x;y\n", "a.csv")
    write(tmp_path, b"1;x;y\n", "b.csv")
    write(tmp_path, b"1;x;y\n", "b.tmp.csv")  # left over by a load
    assert read(spark, str(tmp_path)) == [("1", "x", "y")] * 3


@pytest.mark.parametrize("line", [b"1;x", b"1;x;y;z"])
def test_wrong_field_count(spark, tmp_path, line):
    path = write(tmp_path, b"1;x;y\n" + line + b"\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read(spark, path)
    good, corrupt = split_corrupt(scan(spark, path, NAMES, on_error="quarantine"))
    assert [tuple(r) for r in good.collect()] == [("1", "x", "y")]
    assert [r["_corrupt"].encode() for r in corrupt.collect()] == [line]


def test_multiline(spark, tmp_path):
    path = write(tmp_path, b'1;"x\ny \x80";z\n2;a\x00b;c\n')
    assert read(spark, path, multiline=True) == [("1", "x\ny €", "z"), ("2", "ab", "c")]


def test_na_tokens_only_on_request(spark, tmp_path):
    path = write(tmp_path, b"NA;nan;x\n")
    assert read(spark, path) == [("NA", "nan", "x")]
    assert read(spark, path, na_tokens=NA_TOKENS, encoding="latin-1") == [(None, None, "x")]


def test_latin1_keeps_controls(spark, tmp_path):
    assert read(spark, write(tmp_path, b"\x80;b;c\n"), encoding="latin-1") == [("\x80", "b", "c")]
    with pytest.raises(ValueError, match="encoding"):
        read(spark, str(tmp_path), encoding="utf-8")


def test_round_trip(spark, tmp_path):
    rows = [("a", None, ""), ('q"q', "s;s", "é"), ("b\\", " ", "x,y")]
    df = spark.createDataFrame(rows, text_schema(NAMES))
    write_delimited(df, str(tmp_path / "out"))
    assert read(spark, str(tmp_path / "out")) == sorted(rows, key=repr)


def test_one_parse_per_line(spark, tmp_path, explain):
    rows = scan(spark, write(tmp_path, b"1;x;y\n"), NAMES, on_error="quarantine")
    plan = explain(split_corrupt(rows)[0])
    assert plan.count("from_csv(") == 1
    assert "Exchange" not in plan


def test_large_file_is_split(spark, tmp_path):
    path = write(tmp_path, b"1;x;y\n" * 200_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        rows = scan(spark, path, NAMES)
        assert rows.rdd.getNumPartitions() >= 4
        assert rows.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_routing(spark, tmp_path):
    write(tmp_path, b"1;x\n", "K.PAISCSV")
    write(tmp_path, b"2;y\n2;y\n", "K.MUNICCSV")
    write(tmp_path, b"3;z\n", "Z.ZIP")
    listing = list_files(spark, str(tmp_path))
    routed = {(r["name"], r["table"]) for r in route_files(listing).collect()}
    assert routed == {("K.PAISCSV", "pais"), ("K.MUNICCSV", "munic")}
    assert [r["name"] for r in listing.where(is_archive(F.col("name"))).collect()] == ["Z.ZIP"]
    assert scan_table(spark, str(tmp_path), TABLES["munic"]).count() == 2
    assert {r["size"] for r in listing.where("name like 'K%'").collect()} == {4, 8}


def test_manifest(spark):
    remote = spark.createDataFrame(
        [
            ("missing", 5, 200),
            ("unreachable", None, None),
            ("refused", 5, 404),
            ("same", 5, 200),
            ("other", 6, 200),
            ("unknown", 0, 200),
            ("untold", None, 200),
        ],
        "name string, size bigint, status int",
    )
    names = ("unreachable", "refused", "same", "other", "unknown", "untold")
    local = spark.createDataFrame([(n, 5) for n in names], "name string, size bigint")
    got = {r["name"]: r["fetch"] for r in manifest_diff(remote, local).collect()}
    assert got == {
        "missing": True,
        "unreachable": True,
        "refused": True,
        "same": False,
        "other": True,
        "unknown": False,
        "untold": False,
    }


def test_links(spark):
    html = '<a href="A.zip">A.zip</a><a href="/r/B.ZIP">b</a><a href="http://o/C.zip">c</a><a href="?x">'
    df = spark.createDataFrame([("http://h/d/i.html?q#f", html)], "url string, html string")
    got = [(r.link, r.target) for r in extract_links(df, suffix=".zip").collect()]
    assert got == [
        ("A.zip", "http://h/d/A.zip"),
        ("/r/B.ZIP", "http://h/r/B.ZIP"),
        ("http://o/C.zip", "http://o/C.zip"),
    ]
    bare = spark.createDataFrame([("http://h", '<a href="x">')], "url string, html string")
    assert extract_links(bare).first()["target"] == "http://h/x"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<a data-href="no.zip">', []),
        ('<!-- <a href="no.zip"> --><a href=y.zip>', ["http://h/d/y.zip"]),
        ('<!-- never closed <a href="no.zip">', []),
        ("<script>'<a href=\"no.zip\">'</script><style>href=no</style>", []),
        ("<a href='..&#x2F;x.zip'>", ["http://h/x.zip"]),
        ("<a href='a&#47;..&#47;b&amp;#47;'>", ["http://h/d/b&#47;"]),
        ("<a href=../../../x><a href=./><a href=..>", ["http://h/x", "http://h/d/", "http://h/"]),
        ("<a title='x > y' href=\"q?a=../b#../c\">", ["http://h/d/q?a=../b#../c"]),
        ("<a href='first' href='second'>", ["http://h/d/first"]),
        ("< a href=no><a\nHREF\n=\n'n\ne w'>", ["http://h/d/ne w"]),
        ("<a href='&#128512;&#xD800;&#0;'>", ["http://h/d/\U0001f600\ufffd\ufffd"]),
        ("<a href='&bogus;&lt'>", ["http://h/d/&bogus;&lt"]),
        ("<a href='//o/x/../y'><a href=''>", ["http://o/x/../y"]),
        ("x" * 300_000 + "<p " + "a='b' " * 50_000 + ">" + "<a href=z>", ["http://h/d/z"]),
    ],
)
def test_links_as_a_parser_sees_them(spark, html, want):
    df = spark.createDataFrame([("http://h/d/i.html?q#f", html)], "url string, html string")
    assert [r.target for r in extract_links(df).collect()] == want


def test_url_join_like_the_standard_library(spark):
    import random
    from urllib.parse import urljoin

    from regispark.sources.links import join_url

    draw = random.Random(4)
    parts = ["a", "b.zip", ".", "..", "", "c d"]
    bases = ["http://h/d/e/i.html?q#f", "https://h", "http://h/x/", "http://h:8/y?z"]
    rows = []
    for _ in range(400):
        path = "/".join(draw.choice(parts) for _ in range(draw.randrange(1, 7)))
        if path.strip("/") and not path.startswith("//") and "//" not in path:
            rows.append((draw.choice(bases), path + draw.choice(["", "?s=../t", "#u/../v"])))
    df = spark.createDataFrame(rows, "base string, link string")
    for row in df.withColumn("target", join_url(F.col("base"), F.col("link"))).collect():
        assert row.target == urljoin(row.base, row.link), row
