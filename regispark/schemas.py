"""Declarative table definitions: columns, types, file-name tokens, relationships."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: published column layout of the registry files -------------------------------
# Types: char(n) | text | int | numeric(18,s) | date (yyyyMMdd).

COMPANY_COLUMNS = [
    ("cnpj_basico", "char(8)"),
    ("razao_social", "text"),
    ("natureza_juridica", "int"),
    ("qualificacao_responsavel", "int"),
    ("capital_social", "numeric(18,2)"),
    ("porte_empresa", "int"),
    ("ente_federativo_responsavel", "text"),
]

ESTABLISHMENT_COLUMNS = [
    ("cnpj_basico", "char(8)"),
    ("cnpj_ordem", "char(4)"),
    ("cnpj_dv", "char(2)"),
    ("identificador_matriz_filial", "int"),
    ("nome_fantasia", "text"),
    ("situacao_cadastral", "int"),
    ("data_situacao_cadastral", "date"),
    ("motivo_situacao_cadastral", "int"),
    ("nome_cidade_exterior", "text"),
    ("pais", "int"),
    ("data_inicio_atividade", "date"),
    ("cnae_fiscal_principal", "int"),
    ("cnae_fiscal_secundaria", "text"),
    ("tipo_logradouro", "text"),
    ("logradouro", "text"),
    ("numero", "text"),
    ("complemento", "text"),
    ("bairro", "text"),
    ("cep", "char(8)"),
    ("uf", "char(2)"),
    ("municipio", "int"),
    ("ddd_1", "text"),
    ("telefone_1", "text"),
    ("ddd_2", "text"),
    ("telefone_2", "text"),
    ("ddd_fax", "text"),
    ("fax", "text"),
    ("correio_eletronico", "text"),
    ("situacao_especial", "text"),
    ("data_situacao_especial", "date"),
]

PARTNER_COLUMNS = [
    ("cnpj_basico", "char(8)"),
    ("identificador_socio", "int"),
    ("nome_socio_razao_social", "text"),
    ("cpf_cnpj_socio", "text"),
    ("qualificacao_socio", "int"),
    ("data_entrada_sociedade", "date"),
    ("pais", "int"),
    ("representante_legal", "text"),
    ("nome_do_representante", "text"),
    ("qualificacao_representante_legal", "int"),
    ("faixa_etaria", "int"),
]

TAX_REGIME_COLUMNS = [
    ("cnpj_basico", "char(8)"),
    ("opcao_pelo_simples", "char(1)"),
    ("data_opcao_simples", "date"),
    ("data_exclusao_simples", "date"),
    ("opcao_mei", "char(1)"),
    ("data_opcao_mei", "date"),
    ("data_exclusao_mei", "date"),
]

TEXT_CODE_COLUMNS = [("codigo", "text"), ("descricao", "text")]
INT_CODE_COLUMNS = [("codigo", "int"), ("descricao", "text")]

ACTIVE_STATUS = 2
KEY = "cnpj_basico"
FULL_KEY = "cnpj"
FULL_KEY_PARTS = ("cnpj_basico", "cnpj_ordem", "cnpj_dv")
ACTIVITY_CODE_WIDTH = 7
# --- end of fixed values -----------------------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """One registry table: its name, the token in its file names, and its typed columns."""

    name: str
    token: str
    columns: tuple[tuple[str, str], ...]
    full_key: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def staging(self) -> T.StructType:
        return text_schema(self.names)


def text_schema(names: list[str]) -> T.StructType:
    """All-text schema from a list of names."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


TABLES: dict[str, Table] = {
    table.name: table
    for table in (
        # Table names and file-name tokens.
        Table("empresa", "EMPRE", tuple(COMPANY_COLUMNS)),
        Table("estabelecimento", "ESTABELE", tuple(ESTABLISHMENT_COLUMNS), FULL_KEY_PARTS),
        Table("socios", "SOCIO", tuple(PARTNER_COLUMNS)),
        Table("simples", "SIMPLES", tuple(TAX_REGIME_COLUMNS)),
        Table("cnae", "CNAE", tuple(TEXT_CODE_COLUMNS)),
        Table("moti", "MOTI", tuple(INT_CODE_COLUMNS)),
        Table("munic", "MUNIC", tuple(INT_CODE_COLUMNS)),
        Table("natju", "NATJU", tuple(INT_CODE_COLUMNS)),
        Table("pais", "PAIS", tuple(INT_CODE_COLUMNS)),
        Table("quals", "QUALS", tuple(INT_CODE_COLUMNS)),
    )
}

FACTS = ("empresa", "estabelecimento", "socios", "simples")
DICTIONARIES = ("cnae", "moti", "munic", "natju", "pais", "quals")


@dataclass(frozen=True)
class Link:
    """A declared relationship ``source.column -> target.codigo`` (or base key to base key)."""

    source: str
    column: str
    target: str
    target_column: str = "codigo"
    many: bool = False  # the column holds a comma list of codes


# The relationships of the data model.
LINKS = [
    Link("empresa", "natureza_juridica", "natju"),
    Link("empresa", "qualificacao_responsavel", "quals"),
    Link("estabelecimento", "cnae_fiscal_principal", "cnae"),
    Link("estabelecimento", "cnae_fiscal_secundaria", "cnae", many=True),
    Link("estabelecimento", "pais", "pais"),
    Link("estabelecimento", "municipio", "munic"),
    Link("estabelecimento", "motivo_situacao_cadastral", "moti"),
    Link("socios", "pais", "pais"),
    Link("socios", "qualificacao_socio", "quals"),
    Link("socios", "qualificacao_representante_legal", "quals"),
    Link("empresa", "cnpj_basico", "simples", "cnpj_basico"),
    Link("empresa", "cnpj_basico", "estabelecimento", "cnpj_basico"),
    Link("socios", "cnpj_basico", "empresa", "cnpj_basico"),
    Link("socios", "cnpj_basico", "estabelecimento", "cnpj_basico"),
]


def code_links(source: str) -> list[Link]:
    """Single-valued links from one table into the code dictionaries."""
    return [
        link
        for link in LINKS
        if link.source == source and link.target in DICTIONARIES and not link.many
    ]


def list_links(source: str) -> list[Link]:
    """Links from a column that lists codes."""
    return [link for link in LINKS if link.source == source and link.many]
