"""Filters, joins, pruning, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins
from checks.registry import query, table
from regispark.operators import joins
from regispark.operators.enrich import described_list, enrich, related
from regispark.operators.numbering import row_numbers
from regispark.operators.prune import active_only as active
from regispark.operators.prune import prune
from regispark.operators.typing import type_table
from regispark.schemas import TABLES


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def active_only(spark, folder):
    orders = table(spark, folder, "orders")
    kept = active(orders, status="o_orderstatus", active="F")
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


_SPECIAL = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 1 THEN '' END"


@query(f"""
SELECT o_orderkey, {_SPECIAL} AS special FROM orders
WHERE o_orderstatus = 'F' AND (({_SPECIAL}) IS NULL OR ({_SPECIAL}) = '')""")
def active_no_special(spark, folder):
    orders = table(spark, folder, "orders").withColumn("special", F.expr(_SPECIAL))
    kept = active(
        orders, status="o_orderstatus", active="F", special="special", exclude_special=True
    )
    return kept.select("o_orderkey", "special")


@query("""SELECT * FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) // 2 FROM orders)""")
def point_lookup(spark, folder):
    orders = table(spark, folder, "orders")
    middle = orders.agg(F.expr("max(o_orderkey) div 2")).first()[0]
    return orders.where(F.col("o_orderkey") == F.lit(middle))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_name LIKE 'Customer#0000001%'""")
def prefix_filter(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return customer.where(F.col("c_name").startswith("Customer#0000001"))


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders""")
def star_except(spark, folder):
    return table(spark, folder, "orders").drop("o_orderstatus", "o_totalprice")


@query("""SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def distinct_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


def _customers(spark, folder):
    return table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")


@query("""
SELECT c_custkey AS o_custkey, c_name, o_orderkey, o_orderstatus
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def company_establishment(spark, folder):
    """All customers with all their orders."""
    return joins.company_establishment(
        _customers(spark, folder).select("o_custkey", "c_name"),
        table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"),
        "o_custkey",
    )


_OTHER_KEY = "o_custkey - CASE WHEN o_custkey % 10 = 9 THEN 1 ELSE 0 END"


@query(f"""
SELECT c_custkey AS o_custkey, c_name, o_orderkey, o_orderstatus
FROM customer LEFT JOIN (SELECT {_OTHER_KEY} AS k, * FROM orders) ON c_custkey = k""")
def company_establishment_whole(spark, folder):
    """All orders; those of every tenth customer go to the one before, so that it stays with NULLs."""
    orders = table(spark, folder, "orders").withColumn("o_custkey", F.expr(_OTHER_KEY))
    return joins.company_establishment(
        _customers(spark, folder).select("o_custkey", "c_name"),
        orders.select("o_custkey", "o_orderkey", "o_orderstatus"),
        "o_custkey",
    )


@query(f"""
SELECT c_custkey AS o_custkey, c_name, o_orderkey, o_orderstatus
FROM customer LEFT JOIN (SELECT {_OTHER_KEY} AS k, * FROM orders) ON c_custkey = k""")
def company_establishment_hot(spark, folder):
    """The same where every customer with at least twenty orders counts as hot, and takes the plan for such."""
    orders = table(spark, folder, "orders").withColumn("o_custkey", F.expr(_OTHER_KEY))
    return joins.company_establishment(
        _customers(spark, folder).select("o_custkey", "c_name"),
        orders.select("o_custkey", "o_orderkey", "o_orderstatus"),
        "o_custkey",
        limit=0,
        hot_rows=20,
    )


@query("""
SELECT o_orderpriority, o_orderkey,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS number
FROM orders""")
def number_hot_keys(spark, folder):
    """Row numbers where each key holds a large part of all rows and is numbered by many tasks."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return row_numbers(orders, "o_orderpriority", ["o_orderdate", "o_orderkey"], "number", hot_rows=500).drop("o_orderdate")


@query("""
SELECT c_custkey AS o_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS day
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'""")
def left_join_null_rejecting(spark, folder):
    """A left join that a filter on its right side makes inner: the optimizer sees to it."""
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    companies = _customers(spark, folder).select("o_custkey", "c_name")
    joined = joins.company_establishment(companies, orders, "o_custkey")
    return joined.where(F.col("day") >= F.lit("2000-01-01").cast("date"))


@query("""
SELECT o_orderkey, CAST(o_orderkey * 3 % 2100 AS BIGINT) AS code, p_name AS description
FROM orders LEFT JOIN part ON p_partkey = o_orderkey * 3 % 2100""")
def dim_lookup_activity(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.expr("o_orderkey * 3 % 2100 AS code")
    )
    part = table(spark, folder, "part")
    return joins.lookups(orders, [(part, "code", "description")], code="p_partkey", value="p_name")


@query("""
SELECT o_orderkey, o_custkey % 27 AS city, n_name AS city_name
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 27""")
def dim_lookup_city(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.expr("o_custkey % 27 AS city"))
    nation = table(spark, folder, "nation")
    return joins.lookups(
        orders, [(nation, "city", "city_name")], code="n_nationkey", value="n_name"
    )


def _active_orders(spark, folder):
    return active(table(spark, folder, "orders"), status="o_orderstatus", active="F")


@query("""
SELECT c_custkey AS o_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def prune_company(spark, folder):
    tables = {"empresa": _customers(spark, folder)}
    return prune(tables, _active_orders(spark, folder), key="o_custkey")["empresa"]


@query("""
SELECT * FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o_orderstatus = 'F')""")
def prune_partners(spark, folder):
    keys = _active_orders(spark, folder).withColumnRenamed("o_orderkey", "l_orderkey")
    return prune({"socios": table(spark, folder, "lineitem")}, keys, key="l_orderkey")["socios"]


@query("""
SELECT * FROM orders s
WHERE EXISTS (SELECT 1 FROM orders e WHERE e.o_custkey = s.o_custkey AND e.o_orderstatus = 'F')""")
def prune_tax_regime(spark, folder):
    tables = {"simples": table(spark, folder, "orders")}
    return prune(tables, _active_orders(spark, folder), key="o_custkey")["simples"]


def _typed(spark, folder, *names):
    return {
        name: type_table(standins.raw_table(spark, folder, name), TABLES[name]) for name in names
    }


@query(f"""
SELECT e.*, n_name AS natureza_juridica_descricao, s_name AS qualificacao_responsavel_descricao
FROM ({standins.TYPED_COMPANY_SQL}) e LEFT JOIN nation ON n_nationkey = natureza_juridica
LEFT JOIN supplier ON s_suppkey = qualificacao_responsavel""")
def enriched_company(spark, folder):
    tables = _typed(spark, folder, "empresa", "natju", "quals")
    return enrich("empresa", tables["empresa"], tables)


_PADDED = "array_to_string([lpad(x, 7, '0') FOR x IN string_split(cnae_fiscal_secundaria, ',')], ',')"


@query(f"""
WITH texts AS (SELECT map_from_entries(list({{'k': lpad(CAST(p_partkey AS VARCHAR), 7, '0'), 'v': p_brand || ' ' || p_name}})) AS m
               FROM part)
SELECT e.* REPLACE ({_PADDED} AS cnae_fiscal_secundaria), p_brand || ' ' || p_name AS cnae_fiscal_principal_descricao,
       r_name AS pais_descricao, n_name AS municipio_descricao,
       s_name AS motivo_situacao_cadastral_descricao,
       list_transform(string_split({_PADDED}, ','), lambda x: m[x]) AS cnae_fiscal_secundaria_descricao
FROM texts, ({standins.TYPED_ESTABLISHMENT_SQL}) e LEFT JOIN part ON p_partkey = cnae_fiscal_principal
LEFT JOIN region ON r_regionkey = pais LEFT JOIN nation ON n_nationkey = municipio
LEFT JOIN supplier ON s_suppkey = motivo_situacao_cadastral""")
def enriched_establishment(spark, folder):
    """All codes described, the listed ones too; codes as wide as the dictionary's."""
    tables = _typed(spark, folder, "estabelecimento", "cnae", "pais", "munic", "moti")
    codes = F.transform(F.split("cnae_fiscal_secundaria", ","), lambda c: F.lpad(c, 7, "0"))
    rows = tables["estabelecimento"].withColumn("cnae_fiscal_secundaria", F.array_join(codes, ","))
    return enrich("estabelecimento", rows, tables)


@query(f"""
WITH texts AS (SELECT map_from_entries(list({{'k': CAST(p_partkey AS VARCHAR), 'v': p_name}})) AS m FROM part)
SELECT o_orderkey, list_transform(string_split(list, ','), lambda x: m[x]) AS described
FROM texts, (SELECT o_orderkey, {standins.CODE_LIST_SQL} AS list FROM orders)""")
def described_lists_joined(spark, folder):
    """Listed codes described by a dictionary too large to go with the tasks."""
    orders = table(spark, folder, "orders").select("o_orderkey", standins.code_list().alias("list"))
    part = table(spark, folder, "part")
    found = described_list(orders, "list", part, "described", code="p_partkey", value="p_name", limit=0)
    return found.drop("list")


@query(f"""
SELECT e.*, r_name AS pais_descricao, a.s_name AS qualificacao_socio_descricao,
       b.s_name AS qualificacao_representante_legal_descricao
FROM ({standins.TYPED_PARTNERS_SQL}) e LEFT JOIN region ON r_regionkey = pais
LEFT JOIN supplier a ON a.s_suppkey = qualificacao_socio
LEFT JOIN supplier b ON b.s_suppkey = qualificacao_representante_legal""")
def enriched_partners(spark, folder):
    tables = _typed(spark, folder, "socios", "pais", "quals")
    return enrich("socios", tables["socios"], tables)


def _prefixed_sql(name: str, sql: str, columns: list[str]) -> str:
    renamed = ", ".join(f"{c} AS {name}_{c}" for c in columns if c != "cnpj_basico")
    return f"SELECT cnpj_basico, {renamed} FROM ({sql})"


@query(f"""
SELECT * FROM ({_prefixed_sql("empresa", standins.TYPED_COMPANY_SQL, TABLES["empresa"].names)})
LEFT JOIN ({_prefixed_sql("simples", standins.TYPED_TAX_REGIME_SQL, TABLES["simples"].names)})
USING (cnpj_basico)""")
def related_tax_regime(spark, folder):
    """Companies with their tax regimes."""
    return related("empresa", "simples", _typed(spark, folder, "empresa", "simples"))


@query(f"""
SELECT * FROM ({_prefixed_sql("socios", standins.TYPED_PARTNERS_SQL, TABLES["socios"].names)})
LEFT JOIN ({_prefixed_sql("empresa", standins.TYPED_COMPANY_SQL, TABLES["empresa"].names)})
USING (cnpj_basico)""")
def related_company(spark, folder):
    """Partners with the company they belong to, if it is there."""
    return related("socios", "empresa", _typed(spark, folder, "socios", "empresa"))
