"""Registry-shaped tables made row by row from the test tables.

customer stands for companies, orders for establishments and tax regimes, lineitem for partners,
part for activities, nation for cities, region for countries, supplier for legal natures and
qualifications. Every row of the source table gives one row; some values are turned into the
empty, sentinel, unknown or repeated values that raw files hold. Beside each rendering is the SQL
for the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from regispark.functions.values import padded_code
from regispark.schemas import TABLES


def money(c: str) -> Column:
    """Decimal comma, from an exact decimal so that no exponent is printed."""
    return F.replace(F.col(c).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def digits(c: str) -> Column:
    return F.date_format(c, "yyyyMMdd")


def blank_when(condition: str, c: Column) -> Column:
    return F.when(F.expr(condition), F.lit("")).otherwise(c)


def padded(c: str, width: int) -> Column:
    """Text of a fixed width; what is longer is cut, as char(n) columns are."""
    return F.lpad(F.expr(c).cast("string"), width, "0")


def number(c: str, width: int) -> Column:
    """Number with leading zeros; a longer one keeps all its digits, so that different codes stay different."""
    return padded_code(F.expr(c), width)


def code_list(key: str = "o_orderkey", seed: str = "o_custkey") -> Column:
    """0 to 14 codes per row: NULL, empty, repeated and unknown ones among them."""
    codes = (
        f"array_join(transform(sequence(1, int({key} % 16)), "
        f"i -> string(({seed} * 7 + i * ({key} % 5) * 211) % 2100)), ',')"
    )
    return F.expr(f"CASE {key} % 16 WHEN 0 THEN NULL WHEN 15 THEN '' ELSE {codes} END")


CODE_LIST_SQL = """CASE o_orderkey % 16 WHEN 0 THEN NULL WHEN 15 THEN '' ELSE
    array_to_string([CAST((o_custkey * 7 + i * (o_orderkey % 5) * 211) % 2100 AS VARCHAR)
                     FOR i IN range(1, o_orderkey % 16 + 1)], ',') END"""


# --- raw text, as in the files ---


def company_text(customer: DataFrame) -> DataFrame:
    return customer.select(
        padded("c_custkey", 8).alias("cnpj_basico"),
        F.col("c_name").alias("razao_social"),
        number("c_nationkey", 4).alias("natureza_juridica"),
        blank_when("c_nationkey % 5 = 0", number("c_nationkey", 2)).alias(
            "qualificacao_responsavel"
        ),
        blank_when("c_custkey % 9 = 0", money("c_acctbal")).alias("capital_social"),
        padded("c_custkey % 6", 2).alias("porte_empresa"),
        blank_when("c_custkey % 4 = 0", F.col("c_mktsegment")).alias(
            "ente_federativo_responsavel"
        ),
    )


TYPED_COMPANY_SQL = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
       c_name AS razao_social,
       CAST(c_nationkey AS INTEGER) AS natureza_juridica,
       CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_nationkey AS INTEGER) END
           AS qualificacao_responsavel,
       CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS capital_social,
       CAST(c_custkey % 6 AS INTEGER) AS porte_empresa,
       CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS ente_federativo_responsavel
FROM customer"""


def establishment_text(orders: DataFrame) -> DataFrame:
    status = F.expr("CASE o_orderstatus WHEN 'F' THEN '02' WHEN 'O' THEN '04' ELSE '08' END")
    since = F.expr("o_orderkey % 7 = 0")
    columns = {
        "cnpj_basico": padded("o_custkey", 8),
        "cnpj_ordem": padded("o_orderkey % 10000", 4),
        "cnpj_dv": padded("o_orderkey % 97", 2),
        "identificador_matriz_filial": F.expr("string(o_orderkey % 2 + 1)"),
        "nome_fantasia": blank_when("o_orderkey % 3 = 0", F.col("o_orderpriority")),
        "situacao_cadastral": status,
        "data_situacao_cadastral": F.when(since, F.lit("00000000")).otherwise(
            blank_when("o_orderkey % 11 = 0", digits("o_orderdate"))
        ),
        "motivo_situacao_cadastral": padded("o_orderkey % 64", 2),
        "nome_cidade_exterior": F.lit(""),
        "pais": blank_when("o_orderkey % 5 <> 0", padded("o_custkey % 6", 3)),
        "data_inicio_atividade": digits("o_orderdate"),
        "cnae_fiscal_principal": padded("o_orderkey * 3 % 2100", 7),
        "cnae_fiscal_secundaria": F.coalesce(code_list(), F.lit("")),
        "tipo_logradouro": F.col("o_orderstatus"),
        "logradouro": F.concat(F.lit('RUA "'), F.col("o_orderpriority"), F.lit('"; LJ')),
        "numero": F.expr("string(o_orderkey)"),
        "complemento": F.lit(""),
        "bairro": F.expr("concat('Água ', o_orderkey % 13)"),
        "cep": padded("o_custkey * 13", 8),
        "uf": F.expr("concat(o_orderstatus, o_orderstatus)"),
        "municipio": padded("o_custkey % 27", 4),
        "ddd_1": padded("o_custkey % 90", 2),
        "telefone_1": money("o_totalprice"),
        "ddd_2": F.lit(""),
        "telefone_2": F.lit(""),
        "ddd_fax": F.lit(""),
        "fax": F.lit(""),
        "correio_eletronico": F.expr("concat('c', o_custkey, '@example.com')"),
        "situacao_especial": blank_when("o_orderkey % 10 <> 0", F.lit("ESPÓLIO")),
        "data_situacao_especial": blank_when("o_orderkey % 10 <> 0", digits("o_orderdate")),
    }
    return orders.select(*[c.alias(name) for name, c in columns.items()])


TYPED_ESTABLISHMENT_SQL = f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
       lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS cnpj_ordem,
       lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
       CAST(o_orderkey % 2 + 1 AS INTEGER) AS identificador_matriz_filial,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS nome_fantasia,
       CAST(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 4 ELSE 8 END AS INTEGER)
           AS situacao_cadastral,
       CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END
           AS data_situacao_cadastral,
       CAST(o_orderkey % 64 AS INTEGER) AS motivo_situacao_cadastral,
       CAST(NULL AS VARCHAR) AS nome_cidade_exterior,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey % 6 AS INTEGER) END AS pais,
       CAST(o_orderdate AS DATE) AS data_inicio_atividade,
       CAST(o_orderkey * 3 % 2100 AS INTEGER) AS cnae_fiscal_principal,
       nullif({CODE_LIST_SQL}, '') AS cnae_fiscal_secundaria,
       o_orderstatus AS tipo_logradouro,
       'RUA "' || o_orderpriority || '"; LJ' AS logradouro,
       CAST(o_orderkey AS VARCHAR) AS numero,
       CAST(NULL AS VARCHAR) AS complemento,
       'Água ' || (o_orderkey % 13) AS bairro,
       lpad(CAST(o_custkey * 13 AS VARCHAR), 8, '0') AS cep,
       o_orderstatus || o_orderstatus AS uf,
       CAST(o_custkey % 27 AS INTEGER) AS municipio,
       lpad(CAST(o_custkey % 90 AS VARCHAR), 2, '0') AS ddd_1,
       replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS telefone_1,
       CAST(NULL AS VARCHAR) AS ddd_2, CAST(NULL AS VARCHAR) AS telefone_2,
       CAST(NULL AS VARCHAR) AS ddd_fax, CAST(NULL AS VARCHAR) AS fax,
       'c' || o_custkey || '@example.com' AS correio_eletronico,
       CASE WHEN o_orderkey % 10 = 0 THEN 'ESPÓLIO' END AS situacao_especial,
       CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderdate AS DATE) END AS data_situacao_especial,
       lpad(CAST(o_custkey AS VARCHAR), 8, '0') || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')
           || lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj
FROM orders"""


def partner_text(lineitem: DataFrame) -> DataFrame:
    columns = {
        "cnpj_basico": padded("l_orderkey", 8),
        "identificador_socio": F.expr("string(l_linenumber)"),
        "nome_socio_razao_social": F.expr("concat('Sócio ', l_partkey)"),
        "cpf_cnpj_socio": F.expr("concat('***', l_suppkey, '**')"),
        "qualificacao_socio": number("l_suppkey", 4),
        "data_entrada_sociedade": digits("l_shipdate"),
        "pais": blank_when("l_partkey % 4 <> 0", padded("l_suppkey % 6", 3)),
        "representante_legal": F.lit("***000000**"),
        "nome_do_representante": blank_when("l_returnflag = 'N'", F.col("l_linestatus")),
        "qualificacao_representante_legal": number("int(l_quantity)", 2),
        "faixa_etaria": F.expr("string(l_linenumber % 10)"),
    }
    return lineitem.select(*[c.alias(name) for name, c in columns.items()])


TYPED_PARTNERS_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS cnpj_basico,
       CAST(l_linenumber AS INTEGER) AS identificador_socio,
       'Sócio ' || l_partkey AS nome_socio_razao_social,
       '***' || l_suppkey || '**' AS cpf_cnpj_socio,
       CAST(l_suppkey AS INTEGER) AS qualificacao_socio,
       CAST(l_shipdate AS DATE) AS data_entrada_sociedade,
       CASE WHEN l_partkey % 4 = 0 THEN CAST(l_suppkey % 6 AS INTEGER) END AS pais,
       '***000000**' AS representante_legal,
       CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS nome_do_representante,
       CAST(l_quantity AS INTEGER) AS qualificacao_representante_legal,
       CAST(l_linenumber % 10 AS INTEGER) AS faixa_etaria
FROM lineitem"""


def tax_regime_text(orders: DataFrame) -> DataFrame:
    columns = {
        "cnpj_basico": padded("o_custkey", 8),
        "opcao_pelo_simples": F.col("o_orderstatus"),
        "data_opcao_simples": digits("o_orderdate"),
        "data_exclusao_simples": F.when(
            F.expr("o_orderkey % 7 = 0"), F.lit("00000000")
        ).otherwise(digits("o_orderdate")),
        "opcao_mei": F.col("o_orderpriority"),
        "data_opcao_mei": blank_when("o_orderkey % 2 = 0", digits("o_orderdate")),
        "data_exclusao_mei": F.lit("0"),
    }
    return orders.select(*[c.alias(name) for name, c in columns.items()])


TYPED_TAX_REGIME_SQL = """
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
       o_orderstatus AS opcao_pelo_simples,
       CAST(o_orderdate AS DATE) AS data_opcao_simples,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_exclusao_simples,
       substr(o_orderpriority, 1, 1) AS opcao_mei,
       CASE WHEN o_orderkey % 2 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_opcao_mei,
       CAST(NULL AS DATE) AS data_exclusao_mei
FROM orders"""


def activity_text(part: DataFrame) -> DataFrame:
    return part.select(
        padded("p_partkey", 7).alias("codigo"),
        F.concat_ws(" ", "p_brand", "p_name").alias("descricao"),
    )


def dictionary_text(df: DataFrame, code: str, description: str) -> DataFrame:
    return df.select(
        number(code, 4).alias("codigo"), F.col(description).alias("descricao")
    )


RENDERINGS = {
    "empresa": ("customer", company_text),
    "estabelecimento": ("orders", establishment_text),
    "socios": ("lineitem", partner_text),
    "simples": ("orders", tax_regime_text),
    "cnae": ("part", activity_text),
    "moti": ("supplier", lambda df: dictionary_text(df, "s_suppkey", "s_name")),
    "munic": ("nation", lambda df: dictionary_text(df, "n_nationkey", "n_name")),
    "natju": ("nation", lambda df: dictionary_text(df, "n_nationkey", "n_name")),
    "pais": ("region", lambda df: dictionary_text(df, "r_regionkey", "r_name")),
    "quals": ("supplier", lambda df: dictionary_text(df, "s_suppkey", "s_name")),
}


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A registry table as text."""
    source, render = RENDERINGS[name]
    return render(table(spark, folder, source))


def file_name(table_name: str, part: int = 0) -> str:
    return f"K3241.K03200Y{part}.D50913.{TABLES[table_name].token}CSV"


# --- inputs of the profile ---


def profile_companies(customer: DataFrame, snapshot: Column) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("cnpj_basico"),
        F.col("c_name").alias("razao_social"),
        snapshot.alias("data"),
    )


def profile_establishments(orders: DataFrame, snapshot: Column) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("cnpj"),
        F.col("o_custkey").alias("cnpj_basico"),
        F.col("o_orderstatus").alias("sigla_uf"),
        F.expr("o_custkey % 27").alias("id_municipio"),
        F.expr("string(o_orderkey * 3 % 2100)").alias("cnae_fiscal_principal"),
        code_list().alias("cnae_fiscal_secundaria"),
        snapshot.alias("data"),
    )


def profile_activities(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("cnae_2_3_subclasses"),
        F.concat_ws(" ", "p_brand", "p_name").alias("descricao"),
    )


def profile_cities(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id_municipio"), F.col("n_name").alias("nome")
    )
