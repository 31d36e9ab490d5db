"""Star schema of events, and the cleaning of the records it is made from."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronomart.operators import cleaning, history, star
from chronomart.plans import gold, silver
from chronomart.plans.entities import ENTITIES
from chronomart.plans.store import TableStore
from chronomart.session import materialise, scratch_path
from workload import roles
from workload.registry import query, table

LAST = roles.DAYS[-1]


def member_events(spark, sf):
    cleaned = cleaning.clean_member_events(roles.raw_member_events(spark, sf))
    return history.stamp(cleaned, ["id_deputado", "id_evento"], LAST)


def typed_events(spark, sf):
    """Member events with their times parsed."""
    cleaned = cleaning.clean_member_events(roles.raw_member_events(spark, sf))
    return cleaning.clean_events(cleaned).select(
        "id_evento", "descricao", "descricaoTipo", "situacao", "dataHoraInicio", "dataHoraFim", "id_orgaos"
    )


_TYPED = f"""(SELECT * REPLACE (CAST("dataHoraInicio" AS TIMESTAMP) AS "dataHoraInicio",
                                CAST("dataHoraFim" AS TIMESTAMP) AS "dataHoraFim")
              FROM ({roles.MEMBER_EVENTS_SQL}))"""
_TYPE_KEY = "('0x' || substr(md5({}), 1, 15))::BIGINT"
_ONE_ORGAN = """,
    dim_organ AS (
      SELECT "idOrgao" AS orgao_id, "siglaOrgao" AS sigla, "nomeOrgao" AS nome,
             titulo AS "tipoOrgao", data_inicio, data_fim, is_current FROM organ_history
      QUALIFY row_number() OVER (PARTITION BY "idOrgao"
        ORDER BY is_current DESC, data_inicio DESC, sigla, nome, titulo, data_fim NULLS FIRST) = 1)"""
_DIM_ORGAN = roles.organ_ctes() + _ONE_ORGAN


def _calendar_sql(first: str, last: str) -> str:
    return f"""
    SELECT datediff('day', first, data) AS data_id, data, strftime(data, '%Y') AS ano,
           strftime(data, '%m') AS mes, strftime(data, '%d') AS dia
    FROM (SELECT first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS data
          FROM (SELECT {first} AS first, {last} AS last))"""


@query("dim_organ", f"{_DIM_ORGAN} SELECT * FROM dim_organ", text=["data_inicio", "data_fim"])
def dim_organ(spark, sf):
    return star.dim_organ(roles.organ_history(spark, sf))


@query(
    "dim_organ_bridge",
    f"""{roles.organ_ctes()} SELECT "idOrgao" AS orgao_id, "siglaOrgao" AS sigla,
        "nomePublicacao" AS nome, titulo AS tipo_orgao, id_deputado, nome_deputado
        FROM organ_history WHERE is_current""",
)
def dim_organ_bridge(spark, sf):
    return star.dim_organ_bridge(roles.organ_history(spark, sf))


@query(
    "dim_event_type",
    f"""SELECT {_TYPE_KEY.format("tipo_evento")} AS tipo_evento_id, tipo_evento
        FROM (SELECT DISTINCT event_type AS tipo_evento FROM events)""",
)
def dim_event_type(spark, sf):
    return star.dim_event_type(table(spark, sf, "events"), "event_type")


@query(
    "dim_event_detail",
    f"""SELECT id_evento, descricao, "descricaoTipo" AS tipo_evento, situacao, id_deputado, id_orgaos
        FROM ({roles.MEMBER_EVENTS_SQL})""",
)
def dim_event_detail(spark, sf):
    return star.dim_event_detail(member_events(spark, sf))


@query(
    "dim_calendar_fixed",
    _calendar_sql("DATE '2019-01-01'", "(SELECT max(CAST(ts AS DATE)) FROM events)"),
    text=["data"],
)
def dim_calendar_fixed(spark, sf):
    """From the fixed first day to the last event."""
    return star.calendar(star.fixed_bounds(table(spark, sf, "events"), "ts"))


@query(
    "dim_calendar_data",
    _calendar_sql(
        "(SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)",
        "(SELECT max(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER)) FROM lineitem)",
    ),
    text=["data"],
)
def dim_calendar_data(spark, sf):
    raw = roles.raw_member_events(spark, sf).select("dataHoraInicio", "dataHoraFim")
    return star.calendar(star.event_bounds(cleaning.clean_events(raw)))


def star_schema(spark, sf):
    """Fact and dimensions. Events and organs feed several of them and are written once."""
    events = materialise(typed_events(spark, sf), "events")
    organs = materialise(star.dim_organ(roles.organ_history(spark, sf)), "organs")
    types = star.dim_event_type(events)
    bounds = star.event_bounds(events)
    return star.event_fact(events, organs, bounds), organs, types, star.calendar(bounds)


def _fact_sql(dim_organ: str, first: str, last: str) -> str:
    return f"""{dim_organ},
    typed AS {_TYPED},
    days AS ({_calendar_sql(first, last)}),
    fact AS (
      SELECT d.data_id, o.orgao_id, {_TYPE_KEY.format('e."descricaoTipo"')} AS tipo_evento_id,
             e.descricao, e."dataHoraInicio", e."dataHoraFim", e.situacao, e.id_evento AS evento_id
      FROM (SELECT *, CAST(unnest(string_split(id_orgaos, ',')) AS BIGINT) AS orgao FROM typed) e
      JOIN dim_organ o ON o.orgao_id = e.orgao
      JOIN days d ON d.data = CAST(e."dataHoraInicio" AS DATE))"""


_FACT = _fact_sql(
    _DIM_ORGAN,
    '(SELECT min(CAST("dataHoraInicio" AS DATE)) FROM typed)',
    '(SELECT max(CAST("dataHoraFim" AS DATE)) FROM typed)',
)


@query("fact_event", f"{_FACT} SELECT * FROM fact", text=["dataHoraInicio", "dataHoraFim"])
def fact_event(spark, sf):
    return star_schema(spark, sf)[0]


_MONTHLY = f"""SELECT d.ano, d.mes, e."descricaoTipo" AS tipo_evento, f.orgao_id, o.sigla,
               count(*) AS qtd_registros, count(DISTINCT f.evento_id) AS qtd_eventos
        FROM fact f JOIN days d ON d.data_id = f.data_id JOIN dim_organ o ON o.orgao_id = f.orgao_id
        JOIN (SELECT DISTINCT "descricaoTipo" FROM typed) e
          ON {_TYPE_KEY.format('e."descricaoTipo"')} = f.tipo_evento_id
        GROUP BY 1, 2, 3, 4, 5"""


@query("mart_events", f"{_FACT} {_MONTHLY}")
def mart_events(spark, sf):
    return star.events_mart(*star_schema(spark, sf))


def events_by_order(spark, sf):
    """Line items as events, one an order, from its first to its last day."""
    day = "yyyy-MM-dd'T'HH:mm"
    last = F.date_add("l_shipdate", F.col("l_quantity").cast("int"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.date_format(F.min("l_shipdate"), day).alias("dataHoraInicio"),
        F.date_format(F.max(last), day).alias("dataHoraFim"),
        F.lit("ended").alias("situacao"),
    )


_STORED = _fact_sql(
    roles.organ_ctes(ENTITIES["deputados_orgaos"].tracked, close_missing=False) + _ONE_ORGAN,
    "(SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)",
    "(SELECT max(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER)) FROM lineitem)",
)


@query("mart_pipeline", f"{_STORED} {_MONTHLY}")
def mart_pipeline(spark, sf):
    """From raw records to the saved mart: two loads of organs, the events and what members did, all star tables."""
    store = TableStore(spark, scratch_path(spark, "pipeline"))
    for day in (roles.DAYS[0], LAST):
        silver.run_load(store, "deputados_orgaos", roles.member_organs(spark, sf, day), day)
    silver.run_load(store, "deputados_eventos", roles.raw_member_events(spark, sf), LAST)
    silver.run_load(store, "eventos", events_by_order(spark, sf), LAST)
    gold.build_events(store, LAST)
    return store.read(gold.EVENTS)


# Cleaning -------------------------------------------------------------------------------


@query(
    "clean_expenses",
    """SELECT l_orderkey AS id, l_linenumber AS linha,
              CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS "dataEmissao",
              CAST(l_extendedprice AS DECIMAL(18,2)) AS "valorDocumento",
              CAST(l_discount AS DECIMAL(18,2)) AS "valorGlosa",
              CAST(l_tax AS DECIMAL(18,2)) AS "valorLiquido" FROM lineitem""",
    text=["dataEmissao", "valorDocumento", "valorGlosa", "valorLiquido"],
)
def clean_expenses(spark, sf):
    return cleaning.clean_expenses(raw_expenses(spark, sf))


def raw_expenses(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("linha"),
        F.when(F.col("l_returnflag") == "R", "sem data")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("dataEmissao"),
        F.col("l_extendedprice").alias("valorDocumento"),
        F.col("l_discount").alias("valorGlosa"),
        F.col("l_tax").alias("valorLiquido"),
    )


@query(
    "clean_votes",
    """SELECT event_id AS id, 'http://example.org/' || event_id AS url, CAST(ts AS DATE) AS data,
              CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS "dataHoraRegistro",
              date_trunc('second', ts) AS "ultimaAberturaVotacao_dataHoraRegistro",
              CAST(NULL AS TIMESTAMP) AS "ultimaApresentacaoProposicao_dataHoraRegistro" FROM events""",
    text=[
        "data",
        "dataHoraRegistro",
        "ultimaAberturaVotacao_dataHoraRegistro",
        "ultimaApresentacaoProposicao_dataHoraRegistro",
    ],
)
def clean_votes(spark, sf):
    return cleaning.clean_votes(raw_votes(spark, sf))


def raw_votes(spark, sf):
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("http://example.org/"), F.col("event_id")).alias("uri"),
        F.date_format("ts", "yyyy-MM-dd").alias("data"),
        F.when(F.col("event_type") == "error", "").otherwise(moment).alias("dataHoraRegistro"),
        moment.alias("ultimaAberturaVotacao.dataHoraRegistro"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias(
            "ultimaApresentacaoProposicao.dataHoraRegistro"
        ),
    )


@query(
    "clean_bills",
    """SELECT o_orderkey AS id, 'http://example.org/' || o_orderkey AS url, o_orderpriority AS ementa,
              o_orderdate AS "dataApresentacao",
              CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS "ultimoStatus_data" FROM orders""",
    text=["dataApresentacao", "ultimoStatus_data"],
)
def clean_bills(spark, sf):
    moment = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("http://example.org/"), F.col("o_orderkey")).alias("uri"),
        F.col("o_orderpriority").alias("ementa"),
        moment.alias("dataApresentacao"),
        F.when(F.col("o_orderstatus") != "P", moment).alias("ultimoStatus.data"),
    )
    return cleaning.clean_bills(raw)


@query(
    "clean_topics",
    r"""SELECT page_id AS id, url AS "urlProposicao",
               regexp_extract(url, 'en/(\d+)', 1) AS id_proposicao FROM pages""",
)
def clean_topics(spark, sf):
    raw = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("uriProposicao")
    )
    return cleaning.clean_topics(raw, resource="en")


@query("clean_member_events", roles.MEMBER_EVENTS_SQL)
def clean_member_events(spark, sf):
    return cleaning.clean_member_events(roles.raw_member_events(spark, sf))
