"""Marts built from the loaded tables, saved in the store next to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from chronomart.operators import membership, overlap, star, titles
from chronomart.plans.store import TableStore

# Names of the saved marts.
GROUPS, CATEGORIES, EVENTS = (
    "gold_frentes_parlamentares",
    "gold_frentes_categorias",
    "gold_eventos_legislativos",
)


def _save(store: TableStore, name: str, df: DataFrame, as_of: dt.date | str) -> DataFrame:
    store.overwrite(name, df, as_of)
    return store.read(name)


def build_membership(store: TableStore, as_of: dt.date | str) -> DataFrame:
    return _save(
        store,
        GROUPS,
        membership.membership_mart(
            store.read("legislaturas"),
            store.read_current("frentes_parlamentares"),
            store.read_current("frentes_deputados"),
            store.read_current("deputados"),
        ),
        as_of,
    )


def membership_views(store: TableStore) -> dict[str, DataFrame]:
    """Diversity and rankings over the saved mart, registered as views and returned."""
    mart = store.read(GROUPS)
    views = {
        "vw_herfindahl": membership.diversity_index(mart),
        "vw_dep_mais_frentes": membership.member_ranking(mart),
        "vw_frentes_por_legislatura": membership.groups_per_term(
            store.read_current("frentes_parlamentares")
        ),
        "vw_deputados_orgaos": store.read_current("deputados_orgaos").orderBy(
            "idOrgao", "id_deputado"
        ),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def build_categories(store: TableStore, as_of: dt.date | str) -> DataFrame:
    groups = membership.latest_term(
        store.read_current("frentes_parlamentares"), store.read("legislaturas")
    )
    tagged = titles.with_categories(titles.with_keywords(groups))
    return _save(store, CATEGORIES, tagged, as_of)


def topic_views(store: TableStore) -> dict[str, DataFrame]:
    """Terms, categories, specialised members and overlapping groups over the saved marts."""
    tagged, mart = store.read(CATEGORIES), store.read(GROUPS)
    views = {
        "vw_temas": titles.top_terms(tagged),
        "vw_categorias": titles.category_distribution(tagged),
        "vw_deputados_temas": membership.member_specialisation(mart, tagged),
        "vw_frentes_relacionadas": overlap.overlap_edges(mart),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def build_events(store: TableStore, as_of: dt.date | str) -> dict[str, DataFrame]:
    """Dimensions, fact and the monthly mart of events."""
    member_events = store.read_current("deputados_eventos")
    typed = member_events.withColumns(
        {c: member_events[c].try_cast("timestamp") for c in ("dataHoraInicio", "dataHoraFim")}
    )
    member_organs = store.read("deputados_orgaos")
    bounds = star.event_bounds(store.read_current("eventos"))
    out = {
        "dim_orgao": star.dim_organ(member_organs),
        "dim_orgao_deputado": star.dim_organ_bridge(member_organs),
        "dim_tipo_evento": star.dim_event_type(member_events),
        "dim_evento_deputado": star.dim_event_detail(member_events),
        "dim_data": star.calendar(bounds),
    }
    out = {name: _save(store, name, df, as_of) for name, df in out.items()}
    fact = star.event_fact(typed, out["dim_orgao"], bounds)
    out["fato_evento"] = _save(store, "fato_evento", fact, as_of)
    mart = star.events_mart(
        out["fato_evento"], out["dim_orgao"], out["dim_tipo_evento"], out["dim_data"]
    )
    out[EVENTS] = _save(store, EVENTS, mart, as_of)
    return out
