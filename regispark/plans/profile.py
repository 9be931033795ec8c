"""Wide profile per establishment: company, place, main activity, secondary activities in columns.

A publication lists an establishment once, and then nothing has to be grouped: slots are picked
from the list in place and described by broadcast lookups, in the stage that scans the
establishments. What repeats is found first, by an aggregation over the key column alone, and
only rows of repeated keys take the general plan of numbering, unnesting and pivoting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regispark.functions.codes import slot_count, split_codes
from regispark.functions.values import padded_code
from regispark.operators.joins import having_key, used_entries
from regispark.operators.pivot import pivot_slots
from regispark.operators.sizing import (
    BROADCAST_LIMIT,
    any_repeated,
    broadcast_if_small,
    repeated_values,
)
from regispark.operators.statistics import Statistics
from regispark.schemas import ACTIVITY_CODE_WIDTH
from regispark.session import materialize
from regispark.sinks.publications import Pinned
from regispark.sources.snapshots import at_snapshot

# --- Fixed values: column names of the profile ---
KEYS = [
    "cnpj",
    "razao_social",
    "sigla_uf",
    "id_municipio",
    "nome_municipio",
    "cnae_fiscal_principal",
    "descricao_atividade_principal",
    "data_info",
]
LIST = "cnae_fiscal_secundaria"
CODE = "cnae_secundario"
DESCRIPTION = "descricao_atividade_secundaria"
ACTIVITY = "cnae_2_3_subclasses"
SLOTS = 10
# --- end of fixed values ---


def company_profile(
    companies: DataFrame,
    establishments: DataFrame,
    activities: DataFrame,
    cities: DataFrame,
    *,
    snapshot: object = None,
    prefix: str | None = None,
    slots: int = SLOTS,
    limit: int = BROADCAST_LIMIT,
    known: dict[str, Statistics] | None = None,
) -> DataFrame:
    """One row per establishment with up to ``slots`` secondary activities, described.

    ``snapshot`` restricts both sides to one publication date, ``prefix`` the company name.
    Companies without an establishment in the snapshot do not appear. List items are numbered in
    list order; if an establishment key repeats, numbering goes on across its rows. ``known`` has
    statistics of the inputs by name: what they tell (sizes, keys that do not repeat) is not measured again.
    """
    known = known or {}
    companies = companies.select("cnpj_basico", "razao_social", "data")
    establishments = establishments.select(
        "cnpj", "cnpj_basico", "sigla_uf", "id_municipio", "cnae_fiscal_principal", LIST, "data"
    )
    if snapshot is not None:
        companies = at_snapshot(companies, snapshot, "data")
        establishments = at_snapshot(establishments, snapshot, "data")
    if prefix:
        companies = companies.where(F.col("razao_social").startswith(prefix))
    activities = activities.select(
        F.col(ACTIVITY).alias("_activity"), F.col("descricao").alias("_text")
    )
    cities = cities.select(F.col("id_municipio").alias("_city"), F.col("nome").alias("_name"))

    (companies, few_companies), (activity, few_activities), (city, _) = broadcast_if_small(
        companies, activities, cities, limit=limit,
        known=[known[n].bytes if n in known else None for n in ("companies", "activities", "cities")],
    )
    if not few_activities and limit > 0:
        main = F.array(F.col("cnae_fiscal_principal").cast("string"))
        listed = F.concat(main, F.coalesce(split_codes(F.col(LIST)), F.array().cast("array<string>")))
        used = establishments.select(F.explode(listed).alias("code"))
        activity, few_activities = used_entries(activities, "_activity", used, limit)
        activities = activity
    rows = companies.withColumnRenamed("data", "data_info").join(
        establishments.drop("data"), "cnpj_basico", "inner"
    )

    def described(some: DataFrame) -> DataFrame:
        return (
            some.join(city, F.col("id_municipio") == F.col("_city"), "left")
            .join(activity, F.col("cnae_fiscal_principal") == F.col("_activity"), "left")
            .withColumnsRenamed({"_name": "nome_municipio", "_text": "descricao_atividade_principal"})
            .select(*KEYS, LIST)
        )

    unique = _wide if few_activities else _unnested
    texts, doubled = activity, None
    once = all(n in known and known[n].unique("codigo") for n in ("activities", "cities"))
    if not once and any_repeated(activities.select("_activity"), cities.select("_city")):
        # A main activity or city listed twice doubles its own rows, which take the general plan. Of
        # the descriptions of a listed code a slot shows the largest.
        texts = activities.groupBy("_activity").agg(F.max("_text").alias("_text"))
        texts = F.broadcast(texts) if few_activities else texts.hint("merge")
        rows, doubled = _without_doubled(rows, activities, cities, limit)
        doubled = described(doubled)
    rows = described(rows)

    repeated = None
    if not _keys_are_unique(known):
        repeated = materialize(
            _repeated_keys(companies, establishments, few_companies, limit), "repeated"
        )
        repeated = None if repeated.isEmpty() else repeated
    if repeated is None and doubled is None:
        return unique(rows, texts, slots).select(*profile_columns(slots))
    once, several = rows, doubled
    if repeated is not None:
        ((repeated, _),) = broadcast_if_small(repeated, limit=limit)
        same = F.col("cnpj").eqNullSafe(F.col("_cnpj"))
        once = rows.join(repeated, same, "left_anti")
        more = rows.join(repeated, same, "left_semi")
        several = more if doubled is None else doubled.unionByName(more)
    general = _repeated_profile(several, texts, slots)
    return unique(once, texts, slots).unionByName(general).select(*profile_columns(slots))


def _without_doubled(
    rows: DataFrame, activities: DataFrame, cities: DataFrame, limit: int
) -> tuple[DataFrame, DataFrame]:
    """Rows whose main activity and city are listed once, or not at all, and the others. The codes listed
    more often, no more than a dictionary has, are found first; ``rows`` are not shuffled for few."""
    twice = [
        materialize(repeated_values(df.select(c).dropna(), c), "twice")
        for df, c in ((activities, "_activity"), (cities, "_city"))
    ]
    (activity, _), (city, _) = broadcast_if_small(*twice, limit=limit)
    marked = rows.join(activity, F.col("cnae_fiscal_principal") == F.col("_activity"), "left").join(
        city, F.col("id_municipio") == F.col("_city"), "left"
    )
    alone = F.col("_activity").isNull() & F.col("_city").isNull()
    return marked.where(alone).drop("_activity", "_city"), marked.where(~alone).drop("_activity", "_city")


def profile_columns(slots: int = SLOTS) -> list[str]:
    pairs = [f"{name}_{i}" for i in range(1, slots + 1) for name in (CODE, DESCRIPTION)]
    return [*KEYS[:-1], *pairs, KEYS[-1]]


def _keys_are_unique(known: dict[str, Statistics]) -> bool:
    if not {"companies", "establishments"} <= set(known):
        return False
    establishments = known["establishments"]
    listed_once = establishments.unique("cnpj") and establishments.nulls["cnpj"] <= 1
    return bool(listed_once and known["companies"].unique("cnpj_basico"))


def loaded_profile(registry: Pinned, snapshot: str, **options) -> DataFrame:
    """``company_profile`` of one snapshot of published tables, with the statistics of their loads."""
    named = {"companies": "empresa", "establishments": "estabelecimento", "activities": "cnae", "cities": "munic"}
    tables = {name: registry.table(name) for name in named.values()}
    for name in ("cnae", "munic"):
        tables[name] = at_snapshot(tables[name], str(snapshot))
    known = {role: registry.statistics(name, snapshot) for role, name in named.items()}
    inputs = profile_inputs(tables, F.col("snapshot"))
    return company_profile(**inputs, snapshot=str(snapshot), known=known, **options)


def profile_inputs(tables: dict[str, DataFrame], snapshot: object) -> dict[str, DataFrame]:
    """Arguments of ``company_profile`` from the typed registry tables; ``snapshot`` is a value, or a column of them."""
    date = (snapshot if isinstance(snapshot, Column) else F.lit(snapshot)).alias("data")
    main = padded_code(F.col("cnae_fiscal_principal"), ACTIVITY_CODE_WIDTH)
    return {
        "companies": tables["empresa"].select("cnpj_basico", "razao_social", date),
        "establishments": tables["estabelecimento"].select(
            "cnpj",
            "cnpj_basico",
            F.col("uf").alias("sigla_uf"),
            F.col("municipio").alias("id_municipio"),
            main.alias("cnae_fiscal_principal"),
            LIST,
            date,
        ),
        "activities": tables["cnae"].select(F.col("codigo").alias(ACTIVITY), "descricao"),
        "cities": tables["munic"].select(
            F.col("codigo").alias("id_municipio"), F.col("descricao").alias("nome")
        ),
    }


def _repeated_keys(
    companies: DataFrame, establishments: DataFrame, few_companies: bool, limit: int
) -> DataFrame:
    """Establishment keys, NULL included, that the join of both tables gives more than one row."""
    keys = establishments.select("cnpj", "cnpj_basico")
    if few_companies:
        keys = companies.select("cnpj_basico").join(keys, "cnpj_basico", "inner")
        return repeated_values(keys, "cnpj").withColumnRenamed("cnpj", "_cnpj")
    found = repeated_values(keys, "cnpj")
    twice = materialize(repeated_values(companies.dropna(subset="cnpj_basico"), "cnpj_basico"), "twice")
    if not twice.isEmpty():
        affected = having_key(keys, twice, "cnpj_basico", limit).select("cnpj")
        found = found.unionByName(affected).distinct()
    return found.withColumnRenamed("cnpj", "_cnpj")


def _wide(rows: DataFrame, texts: DataFrame, slots: int) -> DataFrame:
    """Unique rows: slots picked from the list and described in place."""
    numbers = range(1, slots + 1)
    rows = rows.withColumn("_codes", split_codes(F.col(LIST)))
    rows = rows.select(
        *KEYS, *[F.get("_codes", F.lit(i - 1)).alias(f"{CODE}_{i}") for i in numbers]
    )
    for i in numbers:
        text = texts.select(
            F.col("_activity").alias("_code"), F.col("_text").alias(f"{DESCRIPTION}_{i}")
        )
        rows = rows.join(text, F.col(f"{CODE}_{i}") == F.col("_code"), "left").drop("_code")
    return rows


def _unnested(rows: DataFrame, texts: DataFrame, slots: int) -> DataFrame:
    """Unique rows with more activities than can be broadcast: slots picked from the list in place, and one
    join over unnested codes for their descriptions. Keys, places and codes are shuffled for it, and each row once."""
    rows = materialize(rows, "rows").withColumn("_codes", split_codes(F.col(LIST)))
    items = rows.select("cnpj", F.posexplode(F.slice("_codes", 1, slots)).alias("_pos", "_code"))
    found = items.join(texts, F.col("_code") == F.col("_activity")).groupBy(F.col("cnpj").alias("_cnpj"))
    found = found.agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_text"))).alias("_texts"))
    joined = rows.join(found.hint("merge"), F.col("cnpj").eqNullSafe(F.col("_cnpj")), "left")
    picked = []
    for i in range(slots):
        picked.append(F.get("_codes", F.lit(i)).alias(f"{CODE}_{i + 1}"))
        picked.append(F.try_element_at("_texts", F.lit(i)).alias(f"{DESCRIPTION}_{i + 1}"))
    return joined.select(*KEYS, *picked)


def _repeated_profile(rows: DataFrame, texts: DataFrame, slots: int) -> DataFrame:
    """Rows of repeated keys: numbered across the rows of a key, unnested, pivoted.

    Every row fills at least one slot, so the first ``slots`` rows of a key hold all that shows;
    the rank filter is applied before the shuffle too, which bounds what any task gets of one
    key. All key groups then join in with empty slots, combined on the map side.
    """
    in_order = Window.partitionBy("cnpj").orderBy(*KEYS[1:], LIST)
    first = rows.withColumn("_rank", F.row_number().over(in_order))
    first = first.where(F.col("_rank") <= slots).drop("_rank")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    codes = split_codes(F.col(LIST))
    first = first.withColumn("_before", F.coalesce(F.sum(slot_count(codes)).over(earlier), F.lit(0)))
    items = _items(first.withColumn("_codes", codes), texts, slots)
    empty = [F.lit(None).cast(t).alias(c) for c, t in items.dtypes if c not in KEYS]
    groups = rows.select(*KEYS).distinct().select(*KEYS, *empty)
    return _pivoted(items.unionByName(groups), slots)


def _items(rows: DataFrame, texts: DataFrame, slots: int) -> DataFrame:
    """One described row per list item within the slots; at least one row per source row."""
    room = F.greatest(F.lit(slots) - F.col("_before"), F.lit(0)).cast("int")
    within = F.slice("_codes", F.lit(1), room)
    items = rows.select(*KEYS, "_before", F.posexplode_outer(within).alias("_pos", CODE))
    slot = F.col("_before") + F.coalesce(F.col("_pos"), F.lit(0)) + 1
    described = items.join(texts, F.col(CODE) == F.col("_activity"), "left")
    return described.select(
        *KEYS, slot.cast("bigint").alias("_slot"), CODE, F.col("_text").alias(DESCRIPTION)
    )


def _pivoted(items: DataFrame, slots: int) -> DataFrame:
    return pivot_slots(items, KEYS, [CODE, DESCRIPTION], "_slot", slots)
