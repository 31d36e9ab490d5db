"""Cleaning of raw records into typed tables, one function per record family."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.arrays import field_as_int, join_ids
from chronomart.functions.parsing import (
    parse_date,
    parse_timestamp,
    parse_timestamp_strict,
    to_int,
    to_money,
    uri_id,
)
from chronomart.operators.rows import dedupe_by_key
from chronomart.sources.records import rename_by_rule


#: The texts a record came with, while it is cleaned, and those of them that cleaning made null.
RAW, REJECTS = "_raw", "_rejects"


def clean_links(df: DataFrame) -> DataFrame:
    """Only the column names: links and flattened paths."""
    return rename_by_rule(df)


def clean_terms(df: DataFrame) -> DataFrame:
    return rename_by_rule(df).withColumns(
        {"dataInicio": parse_date("dataInicio"), "dataFim": parse_date("dataFim")}
    )


def clean_groups(df: DataFrame) -> DataFrame:
    return rename_by_rule(df).withColumns({"datacriacao": parse_date("datacriacao")})


def clean_group_members(df: DataFrame) -> DataFrame:
    return rename_by_rule(df).withColumns({"iddeputado": to_int("iddeputado")})


def clean_bills(df: DataFrame, strict: bool = True) -> DataFrame:
    """Two timestamps. Strict parsing fails the load on text that is no timestamp;
    ``strict=False`` makes such text null."""
    parse = parse_timestamp_strict if strict else parse_timestamp
    return rename_by_rule(df).withColumns(
        {"dataApresentacao": parse("dataApresentacao"), "ultimoStatus_data": parse("ultimoStatus_data")}
    )


def clean_topics(df: DataFrame, resource: str = "proposicoes") -> DataFrame:
    """The bill's id, taken from its link."""
    renamed = rename_by_rule(df)
    return renamed.withColumn("id_proposicao", uri_id("urlProposicao", resource))


def clean_votes(df: DataFrame) -> DataFrame:
    """A date and three timestamps, of which those that do not parse become null."""
    renamed = rename_by_rule(df)
    stamps = [
        "dataHoraRegistro",
        "ultimaAberturaVotacao_dataHoraRegistro",
        "ultimaApresentacaoProposicao_dataHoraRegistro",
    ]
    return renamed.withColumns(
        {"data": parse_date("data"), **{c: parse_timestamp(c) for c in stamps}}
    )


def clean_events(df: DataFrame) -> DataFrame:
    return rename_by_rule(df).withColumns(
        {
            "dataHoraInicio": parse_timestamp("dataHoraInicio", None),
            "dataHoraFim": parse_timestamp("dataHoraFim", None),
        }
    )


def clean_member_events(df: DataFrame) -> DataFrame:
    """The columns of a member's event, its organs as a delimited id list, one row per
    (member, event)."""
    picked = df.select(
        "id_deputado",
        "nome_deputado",
        F.col("id").alias("id_evento"),
        F.col("uri").alias("url"),
        "dataHoraInicio",
        "dataHoraFim",
        "situacao",
        "descricaoTipo",
        "descricao",
        join_ids(field_as_int("orgaos")).alias("id_orgaos"),
        *([RAW] if RAW in df.columns else []),
    )
    return dedupe_by_key(picked, ["id_deputado", "id_evento"])


def clean_expenses(df: DataFrame) -> DataFrame:
    money = ["valorDocumento", "valorGlosa", "valorLiquido"]
    return df.withColumns(
        {
            "dataEmissao": parse_timestamp("dataEmissao", None),
            **{c: to_money(c) for c in money},
        }
    )


def with_rejects(
    clean: Callable[[DataFrame], DataFrame], raw: DataFrame, unfit: Mapping[str, Column] | None = None
) -> DataFrame:
    """``clean(raw)`` with ``_rejects`` beside each record: ``(field, raw)`` of the values that cleaning made null.

    Fields are those whose type cleaning changes, under their cleaned names. ``unfit`` adds conditions on the raw record,
    by field, for values that cleaning drops inside a list. The record and its rejects come out of one
    pass; ``_rejects`` is null where nothing was lost.
    """
    renamed = dict(zip(rename_by_rule(raw.limit(0)).columns, raw.schema.fields, strict=True))
    texts = {name: F.col(f"`{f.name}`").cast("string") for name, f in renamed.items() if f.dataType.typeName() in _ATOMIC}
    kept = [F.when(F.coalesce(when, F.lit(False)), F.to_json(F.struct(F.col(name)))).alias(f"!{name}") for name, when in (unfit or {}).items()]
    packed = raw.withColumn(RAW, F.struct(*[c.alias(name) for name, c in texts.items()], *kept))
    done = clean(packed)
    types = {f.name: f.dataType for f in done.schema.fields}
    lost = []
    for name in texts:
        if name in types and types[name] != renamed[name].dataType:
            text = F.col(f"{RAW}.`{name}`")
            gone = text.isNotNull() & F.col(f"`{name}`").isNull()
            lost.append(F.when(gone, F.struct(F.lit(name).alias("field"), text.alias("raw"))))
    for name in unfit or {}:
        text = F.col(f"{RAW}.`!{name}`")
        lost.append(F.when(text.isNotNull(), F.struct(F.lit(name).alias("field"), text.alias("raw"))))
    found = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<struct<field:string,raw:string>>")
    return done.withColumn(REJECTS, found).withColumn(REJECTS, F.when(F.size(REJECTS) > 0, F.col(REJECTS))).drop(RAW)


def rejects(cleaned: DataFrame, record: Sequence[str]) -> DataFrame:
    """``(record..., field, raw)`` for each value lost, out of :func:`with_rejects`."""
    return cleaned.select(*record, F.inline(REJECTS))


#: Types whose values have a text of their own.
_ATOMIC = {"string", "byte", "short", "integer", "long", "float", "double", "decimal", "boolean", "date", "timestamp", "timestamp_ntz"}
