"""The test tables in the roles the operators expect, as DataFrames and as SQL.

* entities: customers seen through their orders. On a given day a customer is listed when the
  last order is less than a year old; the last order's priority and status are the attributes
  that change. Between two days customers appear, change and drop out.
* memberships: suppliers are groups, customers their members, years of orders the terms.
* titles: documents (long) and part names (short).
* events: line items, with a list of organ ids; nations are the organs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.operators.history import apply_scd2, first_load, stamp
from chronomart.session import materialise
from workload.registry import table

# Entities -------------------------------------------------------------------------------

DAYS = ("1998-12-31", "1999-12-31", "2001-08-01")
TRACKED = ["nome", "siglaPartido", "siglaUf", "situacao"]
ENTITY_COLUMNS = ["id", *TRACKED]
HISTORY = ["data_inicio", "data_fim", "is_current", "_hash"]


def entities(spark: SparkSession, sf: str, day: str) -> DataFrame:
    """The listed customers on ``day``."""
    orders = table(spark, sf, "orders").where(
        F.col("o_orderdate") <= F.lit(day).cast("timestamp_ntz")
    )
    last = orders.groupBy("o_custkey").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")).alias("o")
    )
    listed = last.where(
        F.col("o.o_orderdate").cast("date") > F.add_months(F.lit(day).cast("date"), -12)
    )
    customer = table(spark, sf, "customer")
    return listed.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.col("o.o_orderpriority").alias("siglaPartido"),
        F.col("c_mktsegment").alias("siglaUf"),
        F.nullif(F.col("o.o_orderstatus"), F.lit("O")).alias("situacao"),
    )


def stamped(spark: SparkSession, sf: str, day: str) -> DataFrame:
    return stamp(entities(spark, sf, day), TRACKED, day)


def entity_history(spark: SparkSession, sf: str, days=DAYS, **options) -> DataFrame:
    """The history table after loading the listing of each of ``days`` in turn."""
    first, *rest = days
    out = first_load(stamped(spark, sf, first), ["id"])
    for day in rest:
        # Written between loads, as a store does: each load reads its target twice.
        out = apply_scd2(materialise(out, "history"), stamped(spark, sf, day), ["id"], day, **options)
    return out


def entities_sql(day: str) -> str:
    return f"""
    SELECT c.c_custkey AS id, c.c_name AS nome, l.o_orderpriority AS "siglaPartido",
           c.c_mktsegment AS "siglaUf", nullif(l.o_orderstatus, 'O') AS situacao
    FROM (SELECT * FROM orders WHERE o_orderdate <= DATE '{day}'
          QUALIFY row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) l
    JOIN customer c ON c.c_custkey = l.o_custkey
    WHERE CAST(l.o_orderdate AS DATE) > CAST(DATE '{day}' - INTERVAL 1 YEAR AS DATE)"""


def hash_sql(columns, mark_nulls: bool = True) -> str:
    parts = [f'CAST("{c}" AS VARCHAR)' for c in columns]
    if mark_nulls:
        parts = [f"coalesce({p}, '\\N')" for p in parts]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def stamped_sql(day: str, source: str | None = None, tracked=TRACKED, mark_nulls=True) -> str:
    return f"""
    SELECT *, DATE '{day}' AS data_inicio, CAST(NULL AS DATE) AS data_fim,
           TRUE AS is_current, {hash_sql(tracked, mark_nulls)} AS _hash
    FROM ({source or entities_sql(day)})"""


def apply_sql(
    target: str, snapshot: str, day: str, columns, keys, close_missing: bool = False
) -> str:
    """Merge and insert as two joins, over relations ``target`` and ``snapshot``."""
    cols = ", ".join(f't."{c}"' for c in columns)
    on = " AND ".join(f's."{k}" IS NOT DISTINCT FROM t."{k}"' for k in keys)
    differs = "(s._hash IS NOT NULL AND s._hash IS DISTINCT FROM t._hash)"
    ends = f"t.is_current AND ({differs}{' OR s._hash IS NULL' if close_missing else ''})"
    return f"""
    SELECT {cols}, t.data_inicio,
           CASE WHEN {ends} THEN DATE '{day}' ELSE t.data_fim END AS data_fim,
           CASE WHEN {ends} THEN FALSE ELSE t.is_current END AS is_current, t._hash
    FROM {target} t LEFT JOIN {snapshot} s ON {on}
    UNION ALL
    SELECT {", ".join(f's."{c}"' for c in columns)}, s.data_inicio, s.data_fim, s.is_current,
           s._hash
    FROM {snapshot} s LEFT JOIN (SELECT * FROM {target} WHERE is_current) t ON {on}
    WHERE t._hash IS NULL OR t._hash IS DISTINCT FROM s._hash"""


def history_ctes(days=DAYS, close_missing: bool = False) -> str:
    """CTEs ``s0, s1, ...`` (stamped listings) and ``h0, h1, ...`` (history after each)."""
    parts = []
    for i, day in enumerate(days):
        parts.append(f"s{i} AS ({stamped_sql(day)})")
        body = (
            "SELECT * FROM s0"
            if i == 0
            else apply_sql(f"h{i - 1}", f"s{i}", day, ENTITY_COLUMNS, ["id"], close_missing)
        )
        parts.append(f"h{i} AS ({body})")
    return "WITH " + ",\n".join(parts)


# Memberships ----------------------------------------------------------------------------

TERM_BASE = 1_000_000_000


def terms(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    return years.select(
        F.col("y").cast("bigint").alias("id"),
        F.make_date("y", F.lit(1), F.lit(1)).alias("dataInicio"),
    )


def _participation(spark: SparkSession, sf: str, group: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("iddeputado"), F.year("o_orderdate").alias("ano")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col(group).alias("grupo"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("ano") * F.lit(TERM_BASE).cast("bigint") + F.col("grupo")).alias("id"),
        "grupo",
        "ano",
        "iddeputado",
    )


TITLES = {"l_suppkey": ("supplier", "s_suppkey", "s_name"), "l_partkey": ("part", "p_partkey", "p_name")}


def groups(spark: SparkSession, sf: str, group: str = "l_suppkey") -> DataFrame:
    source, key, title = TITLES[group]
    found = _participation(spark, sf, group).select("id", "grupo", "ano").distinct()
    return found.join(table(spark, sf, source), F.col("grupo") == F.col(key)).select(
        "id",
        F.col(title).alias("titulo"),
        F.make_date("ano", F.lit(1), F.lit(1)).alias("datacriacao"),
        F.col("ano").cast("bigint").alias("idLegislatura"),
    )


def members(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("nome"),
            F.col("c_mktsegment").alias("siglaPartido"),
            F.col("n_name").alias("siglaUf"),
        )
    )


def memberships(spark: SparkSession, sf: str, group: str = "l_suppkey") -> DataFrame:
    pairs = _participation(spark, sf, group).select("id", "iddeputado").distinct()
    who = members(spark, sf).select(F.col("id").alias("iddeputado"), "nome", "siglaUf")
    return pairs.join(who, "iddeputado").select("id", "iddeputado", "nome", "siglaUf")


def membership_ctes(group: str = "l_suppkey") -> str:
    source, key, title = TITLES[group]
    return f"""WITH terms AS (
    SELECT DISTINCT year(o_orderdate) AS id, make_date(year(o_orderdate), 1, 1) AS "dataInicio"
    FROM orders),
  participation AS (
    SELECT DISTINCT year(o_orderdate) * {TERM_BASE} + {group} AS id, {group} AS grupo,
           year(o_orderdate) AS ano, o_custkey AS iddeputado
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  groups AS (
    SELECT DISTINCT p.id, {title} AS titulo, make_date(ano, 1, 1) AS datacriacao,
           ano AS "idLegislatura"
    FROM participation p JOIN {source} ON grupo = {key}),
  members AS (
    SELECT c_custkey AS id, c_name AS nome, c_mktsegment AS "siglaPartido", n_name AS "siglaUf"
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
  memberships AS (
    SELECT p.id, p.iddeputado, m.nome, m."siglaUf"
    FROM participation p JOIN members m ON m.id = p.iddeputado),
  mart AS (
    SELECT g.id AS id_frente, g.titulo AS nome_frente, g.datacriacao, g."idLegislatura",
           s.iddeputado, s.nome, m."siglaPartido" AS partido, s."siglaUf" AS uf
    FROM groups g JOIN memberships s ON s.id = g.id JOIN members m ON m.id = s.iddeputado
    WHERE g."idLegislatura" = (SELECT id FROM terms ORDER BY "dataInicio" DESC LIMIT 1))"""


# Events and organs ----------------------------------------------------------------------


def raw_member_events(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a member's events with a list of organ records. Return flags stand for
    ids that are no numbers."""
    day = "yyyy-MM-dd'T'HH:mm"
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("id_deputado"),
        F.concat(F.lit("Member "), F.col("l_suppkey")).alias("nome_deputado"),
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("http://example.org/eventos/"), F.col("l_orderkey")).alias("uri"),
        F.date_format("l_shipdate", day).alias("dataHoraInicio"),
        F.date_format(F.date_add("l_shipdate", F.col("l_quantity").cast("int")), day).alias(
            "dataHoraFim"
        ),
        F.col("l_returnflag").alias("situacao"),
        F.concat_ws(" ", F.lit("Tipo"), "l_returnflag", "l_linestatus").alias("descricaoTipo"),
        F.concat_ws(" ", F.lit("Evento"), "l_orderkey", "l_linenumber").alias("descricao"),
        F.array(
            F.struct(F.col("l_linenumber").cast("string").alias("id")),
            F.struct(F.col("l_returnflag").alias("id")),
            F.struct(F.col("l_quantity").cast("int").cast("string").alias("id")),
        ).alias("orgaos"),
    )


MEMBER_EVENTS_SQL = """
    SELECT id_deputado, nome_deputado, id_evento, url, "dataHoraInicio", "dataHoraFim", situacao,
           "descricaoTipo", descricao, id_orgaos
    FROM (
      SELECT l_suppkey AS id_deputado, 'Member ' || l_suppkey AS nome_deputado,
             l_orderkey AS id_evento, 'http://example.org/eventos/' || l_orderkey AS url,
             strftime(l_shipdate, '%Y-%m-%dT%H:%M') AS "dataHoraInicio",
             strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%dT%H:%M')
               AS "dataHoraFim",
             l_returnflag AS situacao,
             'Tipo ' || l_returnflag || ' ' || l_linestatus AS "descricaoTipo",
             'Evento ' || l_orderkey || ' ' || l_linenumber AS descricao,
             l_linenumber || ',' || CAST(l_quantity AS INTEGER) AS id_orgaos
      FROM lineitem)
    QUALIFY row_number() OVER (
      PARTITION BY id_deputado, id_evento
      ORDER BY nome_deputado, url, "dataHoraInicio", "dataHoraFim", situacao, "descricaoTipo",
               descricao, id_orgaos) = 1"""


ORGAN_TRACKED = ["id_deputado", "idOrgao", "nomeOrgao", "siglaOrgao", "titulo"]
ORGAN_COLUMNS = [
    "id_deputado", "nome_deputado", "idOrgao", "siglaOrgao", "nomeOrgao", "nomePublicacao", "titulo",
]


def member_organs(spark: SparkSession, sf: str, day: str) -> DataFrame:
    """Listed customers with their nation as organ and their last order's priority as title."""
    nation = table(spark, sf, "nation")
    home = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        entities(spark, sf, day)
        .join(home, F.col("id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("id").alias("id_deputado"),
            F.col("nome").alias("nome_deputado"),
            F.col("n_nationkey").alias("idOrgao"),
            F.col("n_name").alias("siglaOrgao"),
            F.concat(F.lit("Organ "), F.col("n_name")).alias("nomeOrgao"),
            F.initcap("n_name").alias("nomePublicacao"),
            F.col("siglaPartido").alias("titulo"),
        )
    )


def organ_history(spark: SparkSession, sf: str) -> DataFrame:
    first, _, last = DAYS
    keys = ["id_deputado", "idOrgao"]
    start = first_load(stamp(member_organs(spark, sf, first), ORGAN_TRACKED, first), keys)
    update = stamp(member_organs(spark, sf, last), ORGAN_TRACKED, last)
    return apply_scd2(start, update, keys, last, close_missing=True)


def member_organs_sql(day: str) -> str:
    return f"""
    SELECT e.id AS id_deputado, e.nome AS nome_deputado, n_nationkey AS "idOrgao",
           n_name AS "siglaOrgao", 'Organ ' || n_name AS "nomeOrgao",
           upper(n_name[1]) || lower(n_name[2:]) AS "nomePublicacao", e."siglaPartido" AS titulo
    FROM ({entities_sql(day)}) e JOIN customer ON e.id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey"""


def organ_ctes(tracked=ORGAN_TRACKED, close_missing: bool = True) -> str:
    first, _, last = DAYS
    s0 = stamped_sql(first, member_organs_sql(first), tracked)
    s1 = stamped_sql(last, member_organs_sql(last), tracked)
    applied = apply_sql("m0", "m1", last, ORGAN_COLUMNS, ["id_deputado", "idOrgao"], close_missing)
    return f"WITH m0 AS ({s0}),\nm1 AS ({s1}),\norgan_history AS ({applied})"


# Pages ----------------------------------------------------------------------------------


def page_table(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as pages: orders are the sources, line numbers the page numbers. High
    discounts are failed requests, small quantities empty pages, high taxes last pages."""
    record = F.struct(
        F.col("l_partkey").alias("id"), F.col("l_quantity").cast("bigint").alias("quantidade")
    )
    rel = lambda name: F.struct(F.lit(name).alias("rel"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("source"),
        F.col("l_linenumber").alias("page"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.when(F.col("l_discount") > 0.085, 500).otherwise(200).alias("status"),
        F.when(F.col("l_quantity") > 5, F.array(record)).otherwise(
            F.array().cast("array<struct<id:bigint,quantidade:bigint>>")
        ).alias("dados"),
        F.when(F.col("l_tax") > 0.065, F.array(rel("self")))
        .otherwise(F.array(rel("self"), rel("next")))
        .alias("links"),
    )


PAGES_SQL = """
    SELECT l_orderkey AS source, l_linenumber AS page, year(l_shipdate) AS year,
           CASE WHEN l_discount > 0.085 THEN 500 ELSE 200 END AS status,
           l_quantity > 5 AS has_records, l_tax <= 0.065 AS has_next,
           l_partkey AS id, CAST(l_quantity AS BIGINT) AS quantidade
    FROM lineitem"""

# One row per page, then pages 1, 2, ... as long as each follows the one before and is not the last.
ONE_PAGE_SQL = """
    SELECT * FROM pages_all QUALIFY row_number() OVER (
      PARTITION BY source, page
      ORDER BY year, status, has_records, CASE WHEN has_records THEN id END,
               CASE WHEN has_records THEN quantidade END, has_next) = 1"""

ACCEPTED_SQL = """
    SELECT p.* FROM pages_t p
    LEFT JOIN (SELECT source, min(stop) AS stop FROM (
                 SELECT source, CASE WHEN status = 200 AND has_records THEN page + 1 ELSE page END AS stop
                 FROM pages_t WHERE status <> 200 OR NOT has_records OR NOT has_next
                 UNION ALL
                 SELECT source, page FROM pages_t a WHERE page > 1 AND NOT EXISTS (
                   SELECT 1 FROM pages_t b WHERE b.source = a.source AND b.page = a.page - 1))
               GROUP BY source) s
    ON s.source = p.source
    WHERE s.stop IS NULL OR p.page < s.stop"""


def pages_ctes(where: str = "TRUE") -> str:
    return (
        f"WITH pages_all AS (SELECT * FROM ({PAGES_SQL}) WHERE {where}), "
        f"pages_t AS ({ONE_PAGE_SQL}), accepted AS ({ACCEPTED_SQL})"
    )


PAGES_CTES = pages_ctes()
