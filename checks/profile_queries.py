"""The wide profile and its stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins
from checks.registry import query, table
from regispark.functions import codes
from regispark.operators import joins
from regispark.operators.numbering import row_numbers
from regispark.operators.pivot import pivot_slots
from regispark.operators.prune import active_only
from regispark.operators.typing import type_table
from regispark.plans.profile import company_profile as profile
from regispark.plans.profile import loaded_profile
from regispark.schemas import FULL_KEY, KEY, TABLES
from regispark.session import materialize, scratch_path
from regispark.sinks.publications import Publications

PUBLISHED = "2025-09-01"

_ITEMS = f"""
items AS (
  SELECT o_orderkey, CASE WHEN list IS NULL THEN 1 ELSE slot END AS slot,
         CASE WHEN list IS NOT NULL THEN string_split(list, ',')[slot] END AS code
  FROM (SELECT o_orderkey, list,
               unnest(range(1, coalesce(len(string_split(list, ',')), 1) + 1)) AS slot
        FROM (SELECT o_orderkey, {standins.CODE_LIST_SQL} AS list FROM orders))),
described AS (
  SELECT items.*, p_brand || ' ' || p_name AS description
  FROM items LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = code)"""


def _slots_sql(code: str, description: str) -> str:
    return ", ".join(
        f"max(CASE WHEN slot = {i} THEN code END) AS {code}_{i}, "
        f"max(CASE WHEN slot = {i} THEN description END) AS {description}_{i}"
        for i in range(1, 11)
    )


def _profile_sql(day: str, where: str, more: str = "", cities: str = "nation") -> str:
    """Numbering goes on across the rows of a key, should it repeat. ``more`` activities, other ``cities``."""
    slots = _slots_sql("cnae_secundario", "descricao_atividade_secundaria")
    keys = (
        "cnpj, razao_social, sigla_uf, id_municipio, nome_municipio, cnae_fiscal_principal, "
        "descricao_atividade_principal, data_info"
    )
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in f"{keys}, list".split(",")[1:])
    return f"""
WITH activity AS (
  SELECT CAST(p_partkey AS VARCHAR) AS code, p_brand || ' ' || p_name AS description FROM part {more}),
joined AS (
  SELECT o_orderkey AS cnpj, c_name AS razao_social, o_orderstatus AS sigla_uf,
         o_custkey % 27 AS id_municipio, n_name AS nome_municipio,
         CAST(o_orderkey * 3 % 2100 AS VARCHAR) AS cnae_fiscal_principal,
         description AS descricao_atividade_principal, {day} AS data_info,
         {standins.CODE_LIST_SQL} AS list
  FROM customer JOIN orders ON c_custkey = o_custkey
  LEFT JOIN activity ON code = CAST(o_orderkey * 3 % 2100 AS VARCHAR)
  LEFT JOIN {cities} ON n_nationkey = o_custkey % 27
  {where}),
numbered AS (
  SELECT *, coalesce(len(string_split(list, ',')), 1) AS n,
         coalesce(sum(coalesce(len(string_split(list, ',')), 1)) OVER (
           PARTITION BY cnpj ORDER BY {order}
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM joined),
items AS (
  SELECT {keys}, before + i AS slot, string_split(list, ',')[i] AS item
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM numbered)),
described AS (
  SELECT items.*, item AS code, description
  FROM items LEFT JOIN (SELECT code AS of, max(description) AS description FROM activity GROUP BY 1)
  ON of = item)
SELECT {keys}, {slots} FROM described GROUP BY {keys}"""


def _inputs(spark, folder, companies_day, establishments_day):
    return {
        "companies": standins.profile_companies(table(spark, folder, "customer"), companies_day),
        "establishments": standins.profile_establishments(
            table(spark, folder, "orders"), establishments_day
        ),
        "activities": standins.profile_activities(table(spark, folder, "part")),
        "cities": standins.profile_cities(table(spark, folder, "nation")),
    }


@query(_profile_sql(f"DATE '{PUBLISHED}'", ""))
def company_profile(spark, folder):
    """All companies of one publication."""
    day = F.lit(PUBLISHED).cast("date")
    return profile(**_inputs(spark, folder, day, day))


@query(
    _profile_sql(
        "DATE '1998-01-01'",
        "WHERE c_name LIKE 'Customer#00000%' AND year(o_orderdate) = 1998",
    )
)
def company_profile_snapshot(spark, folder):
    """Companies of one name prefix in one of several publications, as the query is usually put."""
    day = F.lit("1998-01-01").cast("date")
    year = F.trunc("o_orderdate", "year")
    inputs = _inputs(spark, folder, day, year)
    return profile(**inputs, snapshot=_date("1998-01-01"), prefix="Customer#00000")


@query(
    _profile_sql(
        f"DATE '{PUBLISHED}'",
        "",
        "UNION ALL SELECT '33', 'Zz again' UNION ALL SELECT '36', NULL",
        "(SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 5, 'Twice')",
    )
)
def company_profile_repeated_code(spark, folder):
    """Two activities and a city are listed twice: they touch the rows that have them."""
    day = F.lit(PUBLISHED).cast("date")
    inputs = _inputs(spark, folder, day, day)
    more = spark.createDataFrame([("33", "Zz again"), ("36", None)], "cnae_2_3_subclasses string, descricao string")
    inputs["activities"] = inputs["activities"].unionByName(more)
    city = spark.createDataFrame([(5, "Twice")], "id_municipio bigint, nome string")
    inputs["cities"] = inputs["cities"].unionByName(city)
    return profile(**inputs)


def _date(text):
    import datetime

    return datetime.date.fromisoformat(text)


@query("""
SELECT doc_id, string_split(text, ',') AS pieces, CAST(len(string_split(text, ',')) AS INTEGER) AS n
FROM documents""")
def split_codes(spark, folder):
    """Whole texts split at every comma, empty pieces and blanks kept."""
    pieces = codes.split_codes(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", pieces.alias("pieces"), codes.slot_count(pieces).alias("n")
    )


def _items(spark, folder):
    lists = codes.split_codes(standins.code_list())
    rows = table(spark, folder, "orders").select("o_orderkey", lists.alias("codes"))
    return codes.unnest_codes(rows, "codes")


@query(f"WITH {_ITEMS} SELECT o_orderkey, slot, code FROM items")
def unnest_codes(spark, folder):
    return _items(spark, folder)


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS number
FROM lineitem""")
def number_codes(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return row_numbers(items, "l_orderkey", ["l_partkey", "l_linenumber"], "number")


@query(f"WITH {_ITEMS} SELECT o_orderkey, slot, code, description FROM described")
def unnest_codes_described(spark, folder):
    activities = standins.profile_activities(table(spark, folder, "part"))
    return joins.lookups(
        _items(spark, folder),
        [(activities, "code", "description")],
        code="cnae_2_3_subclasses",
        value="descricao",
    )


@query(
    f"WITH {_ITEMS} SELECT o_orderkey, {_slots_sql('code', 'description')} FROM described GROUP BY 1"
)
def pivot_codes(spark, folder):
    described = unnest_codes_described(spark, folder)
    return pivot_slots(described, ["o_orderkey"], ["code", "description"], "slot", 10)


_NUMBERS = range(1, 11)
_LOADED_SLOTS = ", ".join(
    f"slots[{i}] AS cnae_secundario_{i}, a{i}.description AS descricao_atividade_secundaria_{i}" for i in _NUMBERS
)
_LOADED_JOINS = " ".join(f"LEFT JOIN activity a{i} ON a{i}.code = slots[{i}]" for i in _NUMBERS)


@query(f"""
WITH activity AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code, p_brand || ' ' || p_name AS description FROM part),
e AS (SELECT *, [lpad(x, 7, '0') FOR x IN string_split(cnae_fiscal_secundaria, ',')] AS slots,
             lpad(CAST(cnae_fiscal_principal AS VARCHAR), 7, '0') AS main
      FROM ({standins.TYPED_ESTABLISHMENT_SQL}) WHERE situacao_cadastral = 2)
SELECT cnpj, razao_social, uf AS sigla_uf, municipio AS id_municipio, n_name AS nome_municipio,
       main AS cnae_fiscal_principal, m.description AS descricao_atividade_principal, {_LOADED_SLOTS},
       '2025-09' AS data_info
FROM e JOIN ({standins.TYPED_COMPANY_SQL}) USING (cnpj_basico) LEFT JOIN nation ON n_nationkey = municipio
LEFT JOIN activity m ON m.code = main {_LOADED_JOINS}""")
def company_profile_loaded(spark, folder):
    """The profile of the later of two published snapshots; in the earlier one companies had other names."""
    codes_ = F.transform(F.split("cnae_fiscal_secundaria", ","), lambda c: F.lpad(c, 7, "0"))
    listed = F.when(F.col("cnae_fiscal_secundaria") != "", F.array_join(codes_, ","))
    store = Publications(spark, scratch_path(spark, "registry"))
    for snapshot in ("2025-08", "2025-09"):
        raw = {name: standins.raw_table(spark, folder, name) for name in ("empresa", "estabelecimento", "cnae", "munic")}
        raw["estabelecimento"] = raw["estabelecimento"].withColumn("cnae_fiscal_secundaria", F.coalesce(listed, F.lit("")))
        if snapshot == "2025-08":
            raw["empresa"] = raw["empresa"].withColumn("razao_social", F.upper("razao_social"))
        tables = {name: type_table(df, TABLES[name]) for name, df in raw.items()}
        tables["estabelecimento"] = active_only(tables["estabelecimento"])
        with store.publishing() as load:
            for name, df in tables.items():
                keys = {"empresa": [KEY], "estabelecimento": [KEY, FULL_KEY]}.get(name, ["codigo"])
                load.write(name, materialize(df, name), snapshot, keys, clustered=len(keys) > 1 or name == "empresa")
            load.commit()
    return loaded_profile(store.pin(), "2025-09")
