"""Files: scan, route, archives, links, manifests, sinks, incremental ingest, whole load.

Each writes the rows of a test table to files in the scratch folder first and reads those.
"""

from __future__ import annotations

import re
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from checks import standins
from checks.registry import query, table
from regispark.operators.numbering import row_range as rows_in_range
from regispark.operators.typing import type_table, typed
from regispark.plans.load import load_publication, publish_registry
from regispark.schemas import TABLES
from regispark.session import scratch_path
from regispark.sinks import tables as sinks
from regispark.sources.archive_source import register
from regispark.sources.archives import archive_lines, archive_report, scan_archives
from regispark.sources.archives import expand_archives as expand
from regispark.sources.delimited import FORMAT, NA_TOKENS, parse_lines, scan, split_corrupt
from regispark.sources.files import manifest_diff as diff
from regispark.sources.files import route_files as route
from regispark.sources.links import extract_links as links
from regispark.sources.snapshots import at_snapshot
from regispark.streaming.files import FileIngest
from regispark.streaming.ingest import ingest, stream_files, stream_table


@query(standins.TYPED_ESTABLISHMENT_SQL)
def scan_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    sinks.write_delimited(standins.establishment_text(table(spark, folder, "orders")), path)
    establishment = TABLES["estabelecimento"]
    return type_table(scan(spark, path, establishment.names), establishment)


@query("""SELECT doc_id AS id, lang, text FROM documents""")
def scan_multiline(spark, folder):
    """Whole texts with line breaks, quotes and separators inside quoted fields."""
    path = scratch_path(spark, "multiline")
    rows = table(spark, folder, "documents").select(F.expr("string(doc_id)"), "lang", "text")
    sinks.write_delimited(rows, path)
    read = scan(spark, path, ["id", "lang", "text"], multiline=True)
    return read.withColumn("id", F.col("id").cast("bigint"))


_ODD_LINES_SQL = """
SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN lang || '"x"' ELSE lang END AS lang,
       CASE WHEN doc_id % 7 = 0 THEN chr(10) || text || '";' || chr(10) ELSE text END AS text
FROM documents"""


def _odd_lines(spark, folder):
    """Documents as raw lines: quoted line breaks, quotes inside unquoted fields, NULs before a quote."""
    break_ = F.lit("\n")
    text = F.when(F.expr("doc_id % 7 = 0"), F.concat(break_, "text", F.lit('";'), break_)).otherwise(F.col("text"))
    lang = F.when(F.expr("doc_id % 3 = 0"), F.concat("lang", F.lit('"x"'))).otherwise(F.col("lang"))
    nul = F.when(F.expr("doc_id % 5 = 0"), F.lit("\x00")).otherwise(F.lit(""))
    quoted = F.concat(nul, F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(";", F.col("doc_id").cast("string"), lang, quoted)
    return table(spark, folder, "documents").select("doc_id", line.alias("line"))


def _odd_rows(read):
    return read.withColumn("id", F.col("id").cast("bigint"))


ROWS_PER_FILE = 1_000_000
SPLIT = "spark.sql.files.maxPartitionBytes"


@query(_ODD_LINES_SQL)
def scan_multiline_split(spark, folder):
    """Files cut into many splits, with quoted line breaks at their ends."""
    root = scratch_path(spark, "split")
    _put_lines(_odd_lines(spark, folder).select("line"), root, "docs.csv")
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "1m")
    try:
        read = scan(spark, root, ["id", "lang", "text"], multiline=True)
    finally:
        spark.conf.set(SPLIT, before)
    return _odd_rows(read)


@query(_ODD_LINES_SQL)
def scan_zipped_multiline(spark, folder):
    """The same records straight from archives."""
    lines = _odd_lines(spark, folder).select(
        F.expr("'DOCS.' || doc_id % 3").alias("member"), F.expr("'docs' || doc_id % 3").alias("name"), "line"
    )
    root = _zipped(lines, scratch_path(spark, "zips"))
    return _odd_rows(scan_archives(spark, root, ["id", "lang", "text"], multiline=True))


@query("""
SELECT c_custkey, c_name, c_custkey % 3 AS part FROM customer
UNION ALL SELECT c_custkey, c_name, 9 FROM customer""")
def union_files(spark, folder):
    """All files of one domain into one staging table, duplicates kept, by append and by scan."""
    rows = table(spark, folder, "customer").select(
        F.expr("string(c_custkey)"), "c_name", F.expr("string(c_custkey % 3) AS part")
    )
    root = scratch_path(spark, "union")
    paths = [f"{root}/{file_no}" for file_no in range(3)]
    for file_no, path in enumerate(paths):
        sinks.write_delimited(rows.where(F.col("part") == str(file_no)), path)
    sinks.write_delimited(rows.withColumn("part", F.lit("9")), f"{root}/9")
    read = scan(spark, [*paths, f"{root}/9"], ["c_custkey", "c_name", "part"])
    kinds = [("c_custkey", "int"), ("c_name", "text"), ("part", "int")]
    return typed(read, kinds).select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("part").cast("bigint")
    )


@query("""
SELECT name, "table", count(*) AS n FROM (
  SELECT CASE c_nationkey % 4 WHEN 0 THEN 'K' || c_custkey || '.EMPRECSV'
              WHEN 1 THEN 'F' || c_custkey || '.SIMPLES.CSV.D50913'
              WHEN 2 THEN 'empre' || c_custkey || '.csv'
              ELSE 'MUNICCNAE' || c_custkey END AS name, c_nationkey % 4 AS kind
  FROM customer) f
JOIN (VALUES (0, 'empresa'), (1, 'simples'), (3, 'cnae'), (3, 'munic')) t(kind, "table")
  ON f.kind = t.kind
GROUP BY ALL""")
def route_files(spark, folder):
    name = F.expr(
        "CASE c_nationkey % 4 WHEN 0 THEN concat('K', c_custkey, '.EMPRECSV')"
        " WHEN 1 THEN concat('F', c_custkey, '.SIMPLES.CSV.D50913')"
        " WHEN 2 THEN concat('empre', c_custkey, '.csv') ELSE concat('MUNICCNAE', c_custkey) END"
    )
    listing = table(spark, folder, "customer").select(name.alias("name"))
    routed = route(listing).groupBy("name", "table").agg(F.count("*").alias("n"))
    return routed.orderBy("name")


@query("""
SELECT c_custkey,
       CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
            ELSE c_mktsegment END AS segment
FROM customer""")
def scan_na_tokens(spark, folder):
    raw = F.expr(
        "CASE c_custkey % 4 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan' WHEN 2 THEN ''"
        " ELSE c_mktsegment END"
    )
    rows = table(spark, folder, "customer").select(F.expr("string(c_custkey)"), raw)
    path = scratch_path(spark, "na")
    sinks.write_delimited(rows, path)
    names = ["c_custkey", "segment"]
    read = scan(spark, path, names, encoding="latin-1", na_tokens=NA_TOKENS)
    return typed(read, [("c_custkey", "int"), ("segment", "text")]).select(
        F.col("c_custkey").cast("bigint"), "segment"
    )


@query("""
SELECT 'good' AS kind, CAST(o_orderkey AS VARCHAR) AS value FROM orders WHERE o_orderkey % 5 > 1
UNION ALL
SELECT 'corrupt', CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR)
       ELSE o_orderkey || ';a;b' END FROM orders WHERE o_orderkey % 5 <= 1""")
def scan_quarantine(spark, folder):
    """Rows with too few or too many fields, set aside with their line."""
    line = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN string(o_orderkey)"
        " WHEN 1 THEN concat(o_orderkey, ';a;b') ELSE concat(o_orderkey, ';a') END"
    )
    path = scratch_path(spark, "quarantine")
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    good, corrupt = split_corrupt(
        scan(spark, path, ["codigo", "descricao"], on_error="quarantine")
    )
    return good.select(F.lit("good").alias("kind"), F.col("codigo").alias("value")).union(
        corrupt.select(F.lit("corrupt"), "_corrupt")
    )


@query("""
WITH found AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages)
SELECT page_id, link,
       CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link
            WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^:]+:)', 1) || link
            WHEN starts_with(link, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || link
            WHEN starts_with(link, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || link
            WHEN starts_with(link, '#') THEN regexp_extract(url, '^([^#]*)', 1) || link
            ELSE regexp_extract(url, '^([a-z]+://[^?#]*/)', 1) || link END AS target
FROM found""")
def extract_links(spark, folder):
    found = links(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "link", "target")


@query("""
WITH parts AS (
  SELECT page_id, string_split(split_part(split_part(url, '?', 1), '#', 1), '/') AS p FROM pages),
up AS (
  SELECT page_id, p[1:3] AS origin, p[4:greatest(len(p) - 1, 3)] AS folders FROM parts)
SELECT page_id, k AS place,
       CASE k WHEN 0 THEN '../b/./c/x' || page_id || '&d.zip?q=../r' WHEN 1 THEN '/e/../f/..'
              WHEN 2 THEN 'https://o.example/a/../z.zip' ELSE '../../../../é' END AS link,
       CASE k WHEN 0 THEN array_to_string(origin || folders[1:len(folders) - 1] || ['b', 'c', 'x' || page_id || '&d.zip?q=../r'], '/')
              WHEN 1 THEN array_to_string(origin, '/') || '/'
              WHEN 2 THEN 'https://o.example/a/../z.zip' ELSE array_to_string(origin, '/') || '/é' END AS target
FROM up, (SELECT unnest([0, 1, 2, 3]) AS k)""")
def extract_links_parsed(spark, folder):
    """Links as a parser sees them, put into every page among what only looks like links."""
    made = F.concat(
        F.lit("<!-- <a href='no.zip'> --><script>var a = '<a href=\"no2.zip\">'</script><p data-href=no3.zip title='href=no4.zip'>"),
        F.lit("<A Class=x  HREF = '../b/./c&#x2F;x"), F.col("page_id"), F.lit("&amp;d.zip?q=../r'>"),
        F.lit('<a title="a > b" href="/e/../f/.." href="no5.zip">'),
        F.lit("<a disabled href=https://o.example/a/../z.zip>< a href=no6.zip><area href='../../../../&#233;'/>"),
    )
    pages = table(spark, folder, "pages").select("page_id", "url", F.concat(made, F.lit("<p>no"), F.lit("</p>")).alias("html"))
    found = links(pages)
    order = F.when(F.col("link").startswith("../b"), 0).when(F.col("link").startswith("/e"), 1)
    order = order.when(F.col("link").startswith("https"), 2).otherwise(3)
    return found.select("page_id", order.alias("place"), "link", "target")


@query("""
SELECT name, size, last IS NULL OR c_nationkey = 7
       OR (coalesce(size, 0) <> 0 AND size <> CASE WHEN c_nationkey < 12 THEN size ELSE last END)
       AS fetch
FROM (SELECT *, c_name AS name, CASE WHEN c_custkey % 20 = 0 THEN 0 WHEN c_custkey % 21 <> 0
             THEN CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) * 100 AS BIGINT) END AS size
      FROM customer)
LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def manifest_diff(spark, folder):
    """Customers as remote files; those with a closed order exist locally, some of another size."""
    cents = F.expr("bigint(cast(abs(c_acctbal) as decimal(18,2)) * 100)")
    size = F.when(F.expr("c_custkey % 20 = 0"), F.lit(0).cast("bigint")).when(
        F.expr("c_custkey % 21 <> 0"), cents
    )
    status = F.expr("CASE WHEN c_nationkey <> 7 THEN 200 END")
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_name").alias("name"), size.alias("size")
    )
    closed = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    last = closed.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    # A size the server does not tell has no local counterpart to differ from.
    have = F.when(F.col("c_nationkey") < 12, F.coalesce("size", "last")).otherwise(F.col("last"))
    local = customer.join(last, F.col("c_custkey") == F.col("o_custkey")).select(
        "name", have.alias("size")
    )
    remote = customer.select("name", "size", status.alias("status"))
    return diff(remote, local).select("name", "size", "fetch")


@query("""
SELECT year(o_orderdate) AS snapshot, o_orderkey, o_custkey FROM orders
WHERE year(o_orderdate) = 1998""")
def snapshot_filter(spark, folder):
    """One publication of a table partitioned by publication."""
    path = scratch_path(spark, "snapshots")
    orders = table(spark, folder, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("snapshot"), "o_orderkey", "o_custkey"
    )
    orders.write.partitionBy("snapshot").parquet(path)
    read = at_snapshot(spark.read.parquet(path), 1998)
    return read.select(F.col("snapshot").cast("bigint"), "o_orderkey", "o_custkey")


@query("""
SELECT n_name || '.zip' AS archive, 'CNAECSV.' || n_nationkey AS member,
       CAST(sum(octet_length(encode(c_custkey || ';' || c_name)) + 1) AS BIGINT) AS size,
       CAST(NULL AS VARCHAR) AS error
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def expand_archives(spark, folder):
    """Every customer in the archive of its nation; sizes of what comes out."""
    report = archive_report(expand(spark, _archives(spark, folder)))
    # One file per task and nation: add them up to one row per nation.
    archive = F.element_at(F.split("archive", "-"), -1).alias("archive")
    return report.groupBy(archive, "member").agg(
        F.sum("size").alias("size"), F.max("error").alias("error")
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS codigo, c_name AS descricao FROM customer""")
def scan_zipped(spark, folder):
    """Rows straight from archives, without an extracted copy."""
    return scan_archives(spark, _archives(spark, folder), TABLES["cnae"].names)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS codigo, c_name AS descricao FROM customer WHERE c_nationkey % 2 = 0""")
def archive_source(spark, folder):
    """Archives as a data source of their own; members are chosen by name when the scan is planned."""
    register(spark)
    customer = table(spark, folder, "customer").select(
        F.expr("if(c_nationkey % 2 = 0, 'CNAECSV.', 'OTHER.') || c_nationkey").alias("member"),
        F.expr("'nation' || c_nationkey").alias("name"),
        F.expr("concat(c_custkey, ';', c_name)").alias("line"),
    )
    root = _zipped(customer, scratch_path(spark, "zips"))
    blocks = spark.read.format("registry_archives").option("containing", "CNAE").load(root)
    return parse_lines(archive_lines(blocks), TABLES["cnae"].names, decoded=True)


def _archives(spark, folder):
    """Customers as zip files, one per nation and task."""
    customer = table(spark, folder, "customer").join(
        F.broadcast(table(spark, folder, "nation")), F.expr("c_nationkey = n_nationkey")
    )
    lines = customer.select(
        F.expr("'CNAECSV.' || n_nationkey").alias("member"),
        F.col("n_name").alias("name"),
        F.expr("concat(c_custkey, ';', c_name)").alias("line"),
    )
    return _zipped(lines, scratch_path(spark, "zips"))


def _zipped(lines, root):
    """Lines in zip files, one per name and task, written as the rows come."""

    def write(batches):
        written = _OpenFiles(root)
        for batch in batches:
            for (member, name), part in batch.groupby(["member", "name"]):
                data = "".join(f"{x}\n" for x in part["line"]).encode("latin-1")
                written.add(f"{TaskContext.get().partitionId()}-0-{name}.zip", data, member)
        yield written.listed()

    _run(lines.mapInPandas(write, "file string"))
    return root


def _publish(rows, root, file):
    """Delimited text files under a published name, one per task; unlike Spark's own file names
    these hold the token of their table."""
    line = F.to_csv(F.struct("*"), FORMAT | {"quoteAll": "true"})
    _put_lines(rows.select(line.alias("line")), root, file)


def _put_lines(lines, root, file):
    """Text files, one per task, written as the lines come."""

    def write(batches):
        written = _OpenFiles(root)
        for batch in batches:
            data = "".join(text + "\r\n" for text in batch["line"]).encode("latin-1")
            written.add(f"{TaskContext.get().partitionId()}-0-{file}", data)
        yield written.listed()

    _run(lines.mapInPandas(write, "file string"))


class _OpenFiles:
    """Files of one task, that grow batch by batch; a zip file has its member open as long."""

    def __init__(self, root):
        self.root, self.files = root, {}

    def add(self, name, data, member=None):
        if name not in self.files:
            self.files[name] = self._open(name, member)
        self.files[name][-1].write(data)

    def _open(self, name, member):
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(re.sub("^file:/+", "/", self.root))
        target.create_dir(base, recursive=True)
        out = target.open_output_stream(f"{base}/{name}")
        if member is None:
            return (out,)
        archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
        return out, archive, archive.open(member, "w", force_zip64=True)

    def close(self):
        for opened in self.files.values():
            for handle in reversed(opened):
                handle.close()
        return list(self.files)

    def listed(self):
        """Names of the files, which are complete after that; a task without rows has written none."""
        return pd.DataFrame({"file": self.close()}, dtype=object)


def _run(files):
    files.write.format("noop").mode("overwrite").save()


@query("""
SELECT CAST(event_id AS INTEGER) AS event_id, event_type, CAST(ts AS DATE) AS day,
       CAST(value AS DECIMAL(18,2)) AS value FROM events""")
def incremental_ingest(spark, folder):
    """Files in two deliveries, two runs, one more run that finds nothing new."""
    source, target, log = (scratch_path(spark, n) for n in ("landing", "ingested", "log"))
    rows = table(spark, folder, "events").select(
        F.expr("string(event_id)").alias("event_id"),
        "event_type",
        F.date_format("ts", "yyyyMMdd").alias("day"),
        standins.money("value").alias("value"),
    )
    kinds = [("event_id", "int"), ("event_type", "text"), ("day", "date"), ("value", "numeric(18,2)")]
    first = F.col("event_type").isin("click", "error")
    for delivery in (first, ~first):
        batch = rows.where(delivery).repartition(4)
        batch.write.options(sep=";").mode("append").csv(source)
        ingest(stream_files(spark, source, kinds, files_per_batch=3), target, log)
    ingest(stream_files(spark, source, kinds, files_per_batch=3), target, log)
    return spark.read.parquet(target)


@query(standins.TYPED_ESTABLISHMENT_SQL)
def incremental_ingest_establishment(spark, folder):
    """Establishments in two deliveries; files of the first come again with other rows, after a restart."""
    source, target = scratch_path(spark, "landing"), scratch_path(spark, "ingested")
    orders = table(spark, folder, "orders")
    # Files of the same names in each delivery; more of them, not longer ones, where there are more rows.
    orders = orders.repartition(max(6, -(-orders.count() // ROWS_PER_FILE)), "o_orderkey")
    raw = standins.establishment_text(orders)
    first = F.col("cnpj_ordem") < "5000"
    older = raw.where(first).withColumn("bairro", F.lit("NA")).withColumn("uf", F.lit("XX"))
    establishment = TABLES["estabelecimento"]

    def ingested():
        loading = FileIngest(spark, source, target, establishment, files_per_batch=4, na_tokens=("NA",))
        loading.run()
        return loading

    _publish(older, source, standins.file_name("estabelecimento"))
    ingested()
    _publish(raw.where(first), source, standins.file_name("estabelecimento"))
    _publish(raw.where(~first), source, standins.file_name("estabelecimento", 1))
    ingested()
    return ingested().rows().drop("_path")


@query(standins.TYPED_ESTABLISHMENT_SQL)
def stream_establishment(spark, folder):
    """Establishments as a stream of files, typed with the full key; tokens for missing values become NULL."""
    source, target, log = (scratch_path(spark, n) for n in ("landing", "ingested", "log"))
    raw = standins.establishment_text(table(spark, folder, "orders")).withColumn("ddd_2", F.lit("n/a"))
    for part, half in enumerate((F.col("cnpj_ordem") < "5000", F.col("cnpj_ordem") >= "5000")):
        _publish(raw.where(half), source, standins.file_name("estabelecimento", part))
        ingest(stream_table(spark, source, TABLES["estabelecimento"], na_tokens=("n/a",)), target, log)
    return spark.read.parquet(target)


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS codigo, c_name AS descricao FROM customer""")
def stream_archives(spark, folder):
    """Archives that arrive in two deliveries, each member read once."""
    source, target = scratch_path(spark, "zips"), scratch_path(spark, "ingested")
    customer = table(spark, folder, "customer").select(
        F.expr("'CNAECSV.' || c_nationkey").alias("member"),
        F.expr("'nation' || c_nationkey").alias("name"),
        F.expr("concat(lpad(c_custkey, 7, '0'), ';', c_name)").alias("line"),
        "c_nationkey",
    )
    early = F.col("c_nationkey") < 9
    for delivery in (early, ~early):
        _zipped(customer.where(delivery).drop("c_nationkey"), source)
        loading = FileIngest(spark, source, target, TABLES["cnae"], archived=True, files_per_batch=20)
        loading.run()
    return loading.rows().drop("_path")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_orderdate, o_orderkey, o_custkey, o_totalprice LIMIT 500 OFFSET 700""")
def row_range(spark, folder):
    orders = table(spark, folder, "orders")
    chunk = rows_in_range(
        orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        ["o_orderdate", "o_orderkey", "o_custkey", "o_totalprice"],
        700,
        500,
    )
    return chunk.drop("o_orderdate")


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, folder):
    return sinks.row_count(table(spark, folder, "lineitem"))


@query("""
SELECT 'kept' AS step, c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM customer GROUP BY ALL
UNION ALL
SELECT 'appended', c_mktsegment, 2 * count(*), CAST(2 * sum(c_custkey) AS BIGINT)
FROM customer GROUP BY ALL""")
def table_lifecycle(spark, folder):
    """Full refresh over an older table, append, statistics, drop."""
    database = _database(spark)
    rows = table(spark, folder, "customer")
    name = f"{database}.empresa"
    sinks.replace_table(rows.limit(0), name)
    sinks.replace_table(rows, name)
    sinks.replace_table(spark.table(name).select("*"), name)  # from itself
    sinks.append_table(rows, f"{database}.twice")
    sinks.append_table(rows, f"{database}.twice")
    sinks.analyze(spark, name)
    sinks.replace_table(rows, f"{database}.stg_empresa")
    sinks.drop_tables(spark, f"{database}.stg_empresa")
    parts = [
        spark.table(t)
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
        .select(F.lit(step).alias("step"), "c_mktsegment", "n", "keys")
        for step, t in (("kept", name), ("appended", f"{database}.twice"))
    ]
    return parts[0].union(parts[1])


@query("""
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def bucketed_semi_join(spark, folder):
    """Both sides bucketed by key: the join needs no shuffle."""
    database = _database(spark)
    active = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    keys = active.select(F.col("o_orderkey").alias("l_orderkey")).distinct()
    sinks.write_bucketed(items, f"{database}.socios", "l_orderkey", 8)
    sinks.write_bucketed(keys, f"{database}.active", "l_orderkey", 8)
    right = spark.table(f"{database}.active").hint("merge")
    return spark.table(f"{database}.socios").join(right, "l_orderkey", "left_semi")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT max(c_custkey) // 2 FROM customer)""")
def clustered_lookup(spark, folder):
    """All rows of one key from a table clustered and indexed by it."""
    database = _database(spark)
    middle = table(spark, folder, "customer").agg(F.expr("max(c_custkey) div 2")).first()[0]
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name = f"{database}.estabelecimento"
    sinks.write_indexed(sinks.clustered(orders, "o_custkey", "o_orderkey"), name, "o_custkey")
    return spark.table(name).where(F.col("o_custkey") == F.lit(middle))


_ACTIVE = "SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') FROM orders WHERE o_orderstatus = 'F'"


def _dictionary_sql(source, key, description, width=None):
    code = f"lpad(CAST({key} AS VARCHAR), {width}, '0')" if width else f"CAST({key} AS VARCHAR)"
    return f"SELECT {code} AS codigo, {description} AS descricao FROM {source}"


_LOADED = {
    "empresa": f"SELECT * FROM ({standins.TYPED_COMPANY_SQL}) WHERE cnpj_basico IN ({_ACTIVE})",
    "estabelecimento": f"SELECT * FROM ({standins.TYPED_ESTABLISHMENT_SQL}) WHERE situacao_cadastral = 2",
    "socios": f"SELECT * FROM ({standins.TYPED_PARTNERS_SQL}) WHERE cnpj_basico IN ({_ACTIVE})",
    "simples": f"SELECT * FROM ({standins.TYPED_TAX_REGIME_SQL}) WHERE cnpj_basico IN ({_ACTIVE})",
    "cnae": _dictionary_sql("part", "p_partkey", "p_brand || ' ' || p_name", 7),
    "moti": _dictionary_sql("supplier", "s_suppkey", "s_name"),
    "munic": _dictionary_sql("nation", "n_nationkey", "n_name"),
    "natju": _dictionary_sql("nation", "n_nationkey", "n_name"),
    "pais": _dictionary_sql("region", "r_regionkey", "r_name"),
    "quals": _dictionary_sql("supplier", "s_suppkey", "s_name"),
}


def _columns(name):
    return [*TABLES[name].names, *(["cnpj"] if TABLES[name].full_key else [])]


def _hashed_sql(name):
    row = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _columns(name))
    digest = f"CAST('0x' || substr(md5({row}), 1, 12) AS BIGINT)"
    return f"SELECT '{name}' AS \"table\", count(*) AS n, CAST(sum({digest}) AS VARCHAR) AS rows_hash FROM ({_LOADED[name]})"


@query(" UNION ALL ".join(_hashed_sql(name) for name in TABLES))
def load_registry(spark, folder):
    """A whole publication: files of all ten tables, scanned, typed, pruned, written, swapped; all rows count."""
    loaded = _load(spark, folder)
    parts = [_hashed(name, loaded[name]) for name in TABLES]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _hashed(name, df):
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _columns(name)]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 12), 16, 10).cast("decimal(20,0)")
    total = F.sum(digest).cast("decimal(38,0)").cast("string")
    return df.agg(F.lit(name).alias("table"), F.count("*").alias("n"), total.alias("rows_hash"))


def _load(spark, folder):
    return load_publication(spark, _raw_files(spark, folder), _database(spark))


def _raw_files(spark, folder, tables=TABLES):
    root = scratch_path(spark, "publication")
    for name in tables:
        _publish(standins.raw_table(spark, folder, name), root, standins.file_name(name))
    return root


@query(f"""
SELECT * FROM ({standins.TYPED_ESTABLISHMENT_SQL})
WHERE situacao_cadastral = 2 AND cnpj IN (
  SELECT cnpj FROM ({standins.TYPED_ESTABLISHMENT_SQL}) WHERE situacao_cadastral = 2
  ORDER BY cnpj DESC LIMIT 3)""")
def loaded_point_lookup(spark, folder):
    """The three last full keys, looked up in a published registry by its file directory."""
    registry = _published(spark, folder, rows_per_file=2_000)
    keys = registry.table("estabelecimento").select("cnpj").distinct().orderBy(F.desc("cnpj")).limit(3).collect()
    return registry.lookup("estabelecimento", "cnpj", *[r["cnpj"] for r in keys]).drop("snapshot")


def _published(spark, folder, root=None, snapshot="2025-09", **options):
    raw = _raw_files(spark, folder)
    return publish_registry(spark, raw, root or scratch_path(spark, "registry"), snapshot, **options)


def _database(spark):
    path = scratch_path(spark, "db")
    name = "registry_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
ORDER BY o_orderstatus NULLS FIRST, o_orderpriority NULLS FIRST,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END NULLS FIRST, o_orderkey LIMIT 300 OFFSET 4000""")
def row_range_text(spark, folder):
    """A range of rows ordered by texts, a column with NULLs and a key; a small part of them is sorted."""
    seller = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END").alias("seller")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", seller)
    by = ["o_orderstatus", "o_orderpriority", "seller", "o_orderkey"]
    return rows_in_range(orders, by, 4000, 300, small=1000).drop("seller")
