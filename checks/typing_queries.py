"""Value functions and typed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins
from checks.registry import query, table
from regispark.functions import codepage, values
from regispark.operators.typing import split_rejected, type_table, typed
from regispark.schemas import DICTIONARIES, TABLES, text_schema


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
             AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0
            THEN CAST(o_orderdate AS DATE) END AS parsed
FROM orders""")
def parse_date(spark, folder):
    digits = standins.digits("o_orderdate")
    raw = (
        F.when(F.expr("o_orderkey % 7 = 0"), F.lit("00000000"))
        .when(F.expr("o_orderkey % 11 = 0"), F.lit(""))
        .when(F.expr("o_orderkey % 13 = 0"), F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.expr("o_orderkey % 17 = 0"), F.concat(digits, F.lit("\n")))
        .when(F.expr("o_orderkey % 19 = 0"), F.lit("0"))
        .otherwise(digits)
    )
    rows = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", values.date(F.col("raw")).alias("parsed"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS parsed
FROM customer""")
def parse_int(spark, folder):
    raw = F.expr(
        "CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN lpad(string(c_nationkey), 4, '0') "
        "WHEN 2 THEN concat(' ', c_nationkey, ' ') WHEN 3 THEN concat('+', c_nationkey) "
        "ELSE string(c_nationkey) END"
    )
    rows = table(spark, folder, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select("c_custkey", values.integer(F.col("raw")).alias("parsed"))


@query("""
SELECT c_custkey,
       CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS parsed,
       CASE WHEN c_custkey % 9 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(18,1))
       END AS rounded
FROM customer""")
def parse_decimal(spark, folder):
    raw = standins.blank_when("c_custkey % 9 = 0", standins.money("c_acctbal"))
    rows = table(spark, folder, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select(
        "c_custkey",
        values.decimal(F.col("raw")).alias("parsed"),
        values.decimal(F.col("raw"), 1).alias("rounded"),
    )


@query("""
SELECT doc_id, rtrim(substr(nullif(text, ''), 1, 8), ' ') AS char_8, nullif(source, '') AS source,
       rtrim(substr(nullif(lang, ''), 1, 1), ' ') AS char_1
FROM documents""")
def parse_char(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        values.char(F.col("text"), 8).alias("char_8"),
        values.text(F.col("source")).alias("source"),
        values.char(F.col("lang"), 1).alias("char_1"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment FROM customer""")
def empty_to_null(spark, folder):
    raw = standins.blank_when("c_custkey % 4 = 0", F.col("c_mktsegment"))
    rows = table(spark, folder, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select("c_custkey", values.text(F.col("raw")).alias("segment"))


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderkey % 9 <> 0 THEN
            lpad(CAST(o_custkey AS VARCHAR), 8, '0')
            || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')
            || lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') END AS cnpj
FROM orders""")
def full_key(spark, folder):
    parts = (
        standins.padded("o_custkey", 8),
        standins.blank_when("o_orderkey % 9 = 0", standins.padded("o_orderkey % 10000", 4)),
        standins.padded("o_orderkey % 97", 2),
    )
    key = values.full_key(*[values.char(c, n) for c, n in zip(parts, (8, 4, 2))])
    return table(spark, folder, "orders").select("o_orderkey", key.alias("cnpj"))


@query(standins.TYPED_COMPANY_SQL)
def typed_company(spark, folder):
    return type_table(standins.raw_table(spark, folder, "empresa"), TABLES["empresa"])


@query(standins.TYPED_ESTABLISHMENT_SQL)
def typed_establishment(spark, folder):
    return type_table(standins.raw_table(spark, folder, "estabelecimento"), TABLES["estabelecimento"])


@query(standins.TYPED_PARTNERS_SQL)
def typed_partners(spark, folder):
    return type_table(standins.raw_table(spark, folder, "socios"), TABLES["socios"])


@query(standins.TYPED_TAX_REGIME_SQL)
def typed_tax_regime(spark, folder):
    return type_table(standins.raw_table(spark, folder, "simples"), TABLES["simples"])


@query("""
SELECT 'cnae' AS dictionary, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS codigo,
       p_brand || ' ' || p_name AS descricao FROM part
UNION ALL SELECT 'munic', CAST(n_nationkey AS VARCHAR), n_name FROM nation
UNION ALL SELECT 'natju', CAST(n_nationkey AS VARCHAR), n_name FROM nation
UNION ALL SELECT 'pais', CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'moti', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
UNION ALL SELECT 'quals', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def typed_dictionary(spark, folder):
    parts = [
        type_table(standins.raw_table(spark, folder, name), TABLES[name]).select(
            F.lit(name).alias("dictionary"), F.col("codigo").cast("string"), "descricao"
        )
        for name in DICTIONARIES
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS codigo, o_orderpriority AS descricao FROM orders""")
def staging_all_text(spark, folder):
    """Positional names of an all-text schema over columns of any type."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    schema = text_schema(TABLES["cnae"].names)
    return rows.select([F.col(c).cast("string") for c in rows.columns]).toDF(*schema.names)


QUARANTINE = [("codigo", "int"), ("valor", "numeric(18,2)"), ("dia", "date")]


@query("""
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS INTEGER) END AS codigo,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS valor,
       CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE)
       END AS dia
FROM orders""")
def quarantine_values(spark, folder):
    return split_rejected(_dirty(spark, folder))[0]


@query("""
SELECT "column", value, count(*) AS n FROM (
  SELECT 'codigo' AS "column", o_custkey || 'x' AS value FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL
  SELECT 'valor', '1.' || replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
  FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL
  SELECT 'dia', '20230231' FROM orders WHERE o_orderkey % 3 = 0
) GROUP BY ALL""")
def quarantine_rejects(spark, folder):
    rejects = split_rejected(_dirty(spark, folder))[1]
    one = rejects.select(F.inline("_rejected"))
    return one.groupBy("column", "value").agg(F.count("*").alias("n"))


def _dirty(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.expr(
            "CASE WHEN o_orderkey % 5 = 0 THEN concat(o_custkey, 'x') ELSE string(o_custkey) END"
        ).alias("codigo"),
        F.when(
            F.expr("o_orderkey % 7 = 0"), F.concat(F.lit("1."), standins.money("o_totalprice"))
        )
        .otherwise(standins.money("o_totalprice"))
        .alias("valor"),
        F.expr(
            "CASE WHEN o_orderkey % 3 = 0 THEN '20230231' WHEN o_orderkey % 11 = 0 THEN '00000000'"
            " ELSE date_format(o_orderdate, 'yyyyMMdd') END"
        ).alias("dia"),
    )
    return typed(raw, QUARANTINE, on_error="quarantine")


# Characters of the code page from 0x80 to 0x9F, five of which are undefined.
_CP1252 = "€\ufffd‚ƒ„…†‡ˆ‰Š‹Œ\ufffdŽ\ufffd\ufffd‘’“”•–—˜™š›œ\ufffdžŸ"
_LATIN1 = "".join(map(chr, range(0x80, 0xA0)))

# Every byte of the UTF-8 text read as a character of the code page.
_CP1252_SQL = f"""
SELECT doc_id, lang,
       translate(array_to_string([chr(CAST(ascii_code AS INTEGER)) FOR ascii_code IN bytes], ''),
                 '{_LATIN1}', '{_CP1252}') AS decoded
FROM (SELECT doc_id, lang,
             [CAST('0x' || substr(h, 2 * i - 1, 2) AS INTEGER)
              FOR i IN range(1, len(h) // 2 + 1)] AS bytes
      FROM (SELECT doc_id, lang, hex(encode(text)) AS h FROM documents))"""


@query(_CP1252_SQL)
def decode_cp1252(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", "lang", codepage.cp1252(F.col("text").cast("binary")).alias("decoded")
    )


@query("""
SELECT doc_id, text AS clean FROM documents""")
def strip_nul(spark, folder):
    """NULs put between all words of whole texts, then removed."""
    dirty = F.concat(F.lit("\x00"), F.replace("text", F.lit(" "), F.lit("\x00 \x00")))
    rows = table(spark, folder, "documents").select("doc_id", dirty.alias("raw"))
    return rows.select("doc_id", codepage.strip_nul(F.col("raw")).alias("clean"))
