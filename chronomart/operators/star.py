"""Star schema of events: dimensions, calendar, fact and the mart over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.arrays import split_ids
from chronomart.functions.hashing import stable_key
from chronomart.operators.rows import current_rows, dedupe_by_key

# Fixed value: first day of the calendar that is not taken from data.
CALENDAR_START = "2019-01-01"


def calendar(bounds: DataFrame, start: str = "inicio", end: str = "fim") -> DataFrame:
    """Every day from ``start`` to ``end`` of a one-row relation. ``data_id`` counts days from
    the first one, so it does not depend on partitioning. Null bounds give no rows."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    days = bounds.where(first <= last).select(
        first.alias("_first"), F.explode(F.sequence(first, last)).alias("data")
    )
    return days.select(
        F.datediff("data", "_first").cast("bigint").alias("data_id"),
        "data",
        F.date_format("data", "yyyy").alias("ano"),
        F.date_format("data", "MM").alias("mes"),
        F.date_format("data", "dd").alias("dia"),
    )


def fixed_bounds(
    last_day: DataFrame, column: str, start: dt.date | str = CALENDAR_START
) -> DataFrame:
    """Bounds from a fixed first day to the last day found in ``column``."""
    return last_day.agg(F.max(F.col(column).cast("date")).alias("fim")).select(
        F.lit(str(start)).cast("date").alias("inicio"), "fim"
    )


def event_bounds(events: DataFrame, start: str = "dataHoraInicio", end: str = "dataHoraFim") -> DataFrame:
    """Bounds from the earliest start to the latest end. They stay in the plan as one row."""
    return events.agg(
        F.min(start).cast("date").alias("inicio"), F.max(end).cast("date").alias("fim")
    )


def dim_organ(member_organs: DataFrame) -> DataFrame:
    """One row per organ, with the validity of the row that describes it; current rows go
    before closed ones, later before earlier."""
    picked = member_organs.select(
        F.col("idOrgao").alias("orgao_id"),
        F.col("siglaOrgao").alias("sigla"),
        F.col("nomeOrgao").alias("nome"),
        F.col("titulo").alias("tipoOrgao"),
        "data_inicio",
        "data_fim",
        "is_current",
    )
    return dedupe_by_key(
        picked, ["orgao_id"], [F.col("is_current").desc(), F.col("data_inicio").desc()]
    )


def dim_organ_bridge(member_organs: DataFrame) -> DataFrame:
    """Current (organ, member) rows."""
    return current_rows(member_organs).select(
        F.col("idOrgao").alias("orgao_id"),
        F.col("siglaOrgao").alias("sigla"),
        F.col("nomePublicacao").alias("nome"),
        F.col("titulo").alias("tipo_orgao"),
        "id_deputado",
        "nome_deputado",
    )


def dim_event_type(member_events: DataFrame, column: str = "descricaoTipo") -> DataFrame:
    """Distinct event types, each with a key computed from its name."""
    return (
        member_events.select(F.col(column).alias("tipo_evento"))
        .distinct()
        .select(stable_key("tipo_evento").alias("tipo_evento_id"), "tipo_evento")
    )


def dim_event_detail(member_events: DataFrame) -> DataFrame:
    """Current (event, member) rows."""
    return current_rows(member_events).select(
        "id_evento",
        "descricao",
        F.col("descricaoTipo").alias("tipo_evento"),
        "situacao",
        "id_deputado",
        "id_orgaos",
    )


def on_day(events: DataFrame, days: DataFrame, moment: str | Column = "dataHoraInicio") -> DataFrame:
    """Events with the calendar row of their day."""
    m = F.col(moment) if isinstance(moment, str) else moment
    return events.join(days, m.cast("date") == days["data"])


def event_fact(events: DataFrame, organs: DataFrame, bounds: DataFrame) -> DataFrame:
    """One row per event and organ of its id list, with the keys of organ, type and day.

    Type and day keys are functions of the event's own values (:func:`dim_event_type` names the
    type by :func:`stable_key`, :func:`calendar` numbers days from the first), so neither
    dimension is joined: few types or days would make few, hot join keys. Only the organ list is,
    as a semi join, which may split a hot organ's events. ``bounds`` is the calendar's one-row
    relation; events outside it, without a type, or of unknown organs are left out, as inner
    joins with the dimensions would.
    """
    first, last = bounds.select("inicio").scalar(), bounds.select("fim").scalar()
    day = F.col("dataHoraInicio").cast("date")
    placed = events.where(day.between(first, last) & F.col("descricaoTipo").isNotNull())
    # The keys are computed for each event before its organs are listed, not for each of its organs.
    keyed = placed.select(
        F.datediff(day, first).cast("bigint").alias("data_id"),
        split_ids("id_orgaos").alias("_organs"),
        stable_key("descricaoTipo").alias("tipo_evento_id"),
        "descricao",
        "dataHoraInicio",
        "dataHoraFim",
        "situacao",
        F.col("id_evento").alias("evento_id"),
    )
    rest = keyed.columns[2:]
    exploded = keyed.select("data_id", F.explode("_organs").alias("orgao_id"), *rest)
    exploded = exploded.withColumn("orgao_id", F.col("orgao_id").try_cast("bigint"))
    known = organs.select(F.col("orgao_id").cast("bigint"))
    return exploded.join(known, "orgao_id", "left_semi").select(
        "data_id", *[c for c in exploded.columns if c != "data_id"]
    )


def events_mart(
    fact: DataFrame, organs: DataFrame, types: DataFrame, days: DataFrame
) -> DataFrame:
    """Rows and distinct events per year, month, type and organ.

    The fact is counted by its keys first; the dimensions then meet the counts, not the rows.
    """
    counted = (
        fact.join(days.select("data_id", "ano", "mes"), "data_id")
        .groupBy("ano", "mes", "tipo_evento_id", "orgao_id")
        .agg(
            F.count("*").alias("qtd_registros"),
            F.count_distinct("evento_id").alias("qtd_eventos"),
        )
    )
    return (
        counted.join(types, "tipo_evento_id")
        .join(organs.select("orgao_id", "sigla"), "orgao_id")
        .select("ano", "mes", "tipo_evento", "orgao_id", "sigla", "qtd_registros", "qtd_eventos")
    )
