"""Row history: stamping, loading, questions over it, and append loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronomart.operators import cleaning, history, loads
from chronomart.plans.store import TableStore
from chronomart.session import scratch_path
from workload import roles
from workload.registry import query, table

FIRST, SECOND, LAST = roles.DAYS
_DATES = ["data_inicio", "data_fim"]
_ALL = ", ".join(f'"{c}"' for c in [*roles.ENTITY_COLUMNS, *roles.HISTORY])


@query("scd2_stamp", roles.stamped_sql(LAST), text=_DATES)
def scd2_stamp(spark, sf):
    return roles.stamped(spark, sf, LAST)


@query(
    "scd2_upgrade",
    f"""WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS situacao, o_orderpriority AS nome,
                          CASE WHEN o_orderstatus = 'F' THEN FALSE END AS is_current FROM orders)
        SELECT id, situacao, nome, coalesce(is_current, TRUE) AS is_current,
               CASE WHEN is_current IS NULL THEN DATE '{LAST}' END AS data_inicio,
               CAST(NULL AS DATE) AS data_fim,
               CASE WHEN is_current IS NULL THEN {roles.hash_sql(["nome", "situacao"])} END AS _hash
        FROM o""",
    text=_DATES,
)
def scd2_upgrade(spark, sf):
    """Some rows have a state already and keep it; all others become current."""
    partly = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("situacao"),
        F.col("o_orderpriority").alias("nome"),
        F.when(F.col("o_orderstatus") == "F", F.lit(False)).alias("is_current"),
    )
    return history.upgrade_to_history(partly, ["nome", "situacao"], LAST)


@query("scd2_apply", f"{roles.history_ctes()} SELECT {_ALL} FROM h2", text=_DATES)
def scd2_apply(spark, sf):
    return roles.entity_history(spark, sf)


@query(
    "scd2_apply_close_missing",
    f"{roles.history_ctes(close_missing=True)} SELECT {_ALL} FROM h2",
    text=_DATES,
)
def scd2_apply_close_missing(spark, sf):
    return roles.entity_history(spark, sf, close_missing=True)


CHAIN = ("1997-12-31", "1998-12-31", "1999-12-31", "2000-12-31", "2001-08-01")


@query("scd2_apply_chain", f"{roles.history_ctes(CHAIN)} SELECT {_ALL} FROM h4", text=_DATES)
def scd2_apply_chain(spark, sf):
    return roles.entity_history(spark, sf, CHAIN)


_LINK_TRACKED = ["id", "iddeputado", "tituloDeputado"]
_LINK_COLUMNS = ["id", "iddeputado", "tituloDeputado", "nome"]


def _links(spark, sf, day):
    """Line items shipped by ``day`` as memberships with a key that is partly null and not
    unique."""
    return (
        table(spark, sf, "lineitem")
        .where(F.col("l_shipdate") <= F.lit(day).cast("timestamp_ntz"))
        .select(
            F.col("l_orderkey").alias("id"),
            F.nullif("l_linenumber", F.lit(1)).alias("iddeputado"),
            F.col("l_returnflag").alias("tituloDeputado"),
            F.concat(F.lit("Member "), F.col("l_suppkey")).alias("nome"),
        )
    )


def _links_sql(day):
    return f"""
    SELECT l_orderkey AS id, nullif(l_linenumber, 1) AS iddeputado,
           l_returnflag AS "tituloDeputado", 'Member ' || l_suppkey AS nome
    FROM lineitem WHERE l_shipdate <= DATE '{day}'
    QUALIFY row_number() OVER (PARTITION BY id, iddeputado ORDER BY "tituloDeputado", nome) = 1"""


@query(
    "scd2_apply_composite",
    f"""WITH l0 AS ({roles.stamped_sql(FIRST, _links_sql(FIRST), _LINK_TRACKED)}),
        l1 AS ({roles.stamped_sql(LAST, _links_sql(LAST), _LINK_TRACKED)})
        {roles.apply_sql("l0", "l1", LAST, _LINK_COLUMNS, ["id", "iddeputado"])}""",
    text=_DATES,
)
def scd2_apply_composite(spark, sf):
    keys = ["id", "iddeputado"]
    start = history.first_load(history.stamp(_links(spark, sf, FIRST), _LINK_TRACKED, FIRST), keys)
    update = history.stamp(_links(spark, sf, LAST), _LINK_TRACKED, LAST)
    return history.apply_scd2(start, update, keys, LAST, null_safe=True)


_NULL_KEYED = """SELECT nullif(c_nationkey, 3) AS id, nullif(c_mktsegment, 'BUILDING') AS segmento,
    min(c_name) AS nome, {value} AS situacao FROM customer GROUP BY 1, 2"""
_NULL_COLUMNS = ["id", "segmento", "nome", "situacao"]


def _null_keyed(spark, sf, value):
    return (
        table(spark, sf, "customer")
        .groupBy(F.nullif("c_nationkey", F.lit(3)).alias("id"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segmento"))
        .agg(F.min("c_name").alias("nome"), value.cast("bigint").alias("situacao"))
    )


@query(
    "scd2_apply_null_key",
    f"""WITH n0 AS ({roles.stamped_sql(FIRST, _NULL_KEYED.format(value="CAST(0 AS BIGINT)"), ["situacao"])}),
        n1 AS ({roles.stamped_sql(LAST, _NULL_KEYED.format(value="count(*) % 2"), ["situacao"])})
        {roles.apply_sql("n0", "n1", LAST, _NULL_COLUMNS, ["id", "segmento"])}""",
    text=_DATES,
)
def scd2_apply_null_key(spark, sf):
    """Keys of which one or both parts are null have one current row each, by the default join."""
    keys = ["id", "segmento"]
    start = history.first_load(history.stamp(_null_keyed(spark, sf, F.max(F.lit(0))), ["situacao"], FIRST), keys)
    update = history.stamp(_null_keyed(spark, sf, F.count("*") % 2), ["situacao"], LAST)
    return history.apply_scd2(start, update, keys, LAST)


@query(
    "scd2_first_load",
    roles.stamped_sql(LAST, _links_sql(LAST), _LINK_TRACKED),
    text=_DATES,
)
def scd2_first_load(spark, sf):
    links = history.stamp(_links(spark, sf, LAST), _LINK_TRACKED, LAST)
    return history.first_load(links, ["id", "iddeputado"])


@query(
    "scd2_change_summary",
    f"""{roles.history_ctes(roles.DAYS[:2])}
        SELECT closed, inserted, kept, CASE WHEN closed + inserted > 0
               THEN inserted || ' rows applied' ELSE 'no change' END AS message
        FROM (SELECT count(*) FILTER (NOT is_current) AS closed,
                     count(*) FILTER (is_current AND data_inicio = DATE '{SECOND}') AS inserted,
                     count(*) FILTER (is_current AND data_inicio < DATE '{SECOND}') AS kept FROM h1)""",
)
def scd2_change_summary(spark, sf):
    start = history.first_load(roles.stamped(spark, sf, FIRST), ["id"])
    changes = history.snapshot_changes(start, roles.stamped(spark, sf, SECOND), ["id"], SECOND)
    return history.change_summary(changes)


# Questions ------------------------------------------------------------------------------


@query("his_current", f"{roles.history_ctes()} SELECT {_ALL} FROM h2 WHERE is_current", text=_DATES)
def his_current(spark, sf):
    return history.current(roles.entity_history(spark, sf))


_LONGEST = "SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1"


@query(
    "his_timeline",
    f"""{roles.history_ctes()} SELECT id, nome, "siglaPartido", data_inicio, data_fim, is_current
        FROM h2 WHERE id = ({_LONGEST}) ORDER BY data_inicio DESC""",
    text=_DATES,
)
def his_timeline(spark, sf):
    """The versions of the customer with the most orders."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    busiest = orders.orderBy(F.col("n").desc(), "o_custkey").limit(1).select("o_custkey").scalar()
    return history.timeline(
        roles.entity_history(spark, sf),
        "id",
        busiest,
        ["id", "nome", "siglaPartido", "data_inicio", "data_fim", "is_current"],
    )


_POINT = "2000-06-30"


@query(
    "his_point_in_time",
    f"""{roles.history_ctes()} SELECT {_ALL} FROM h2
        WHERE data_inicio <= DATE '{_POINT}' AND (data_fim IS NULL OR data_fim > DATE '{_POINT}')""",
    text=_DATES,
)
def his_point_in_time(spark, sf):
    return history.as_of(roles.entity_history(spark, sf), _POINT)


@query(
    "his_recent",
    f"""{roles.history_ctes()} SELECT {_ALL} FROM h2
        WHERE data_inicio >= DATE '2001-08-05' - INTERVAL 7 DAY""",
    text=_DATES,
)
def his_recent(spark, sf):
    return history.changed_since(roles.entity_history(spark, sf), "2001-08-05", days=7)


@query(
    "his_version_counts",
    f"""{roles.history_ctes()} SELECT id, nome, count(*) AS num_versoes FROM h2
        GROUP BY id, nome HAVING count(*) > 1""",
)
def his_version_counts(spark, sf):
    return history.version_counts(roles.entity_history(spark, sf), ["id", "nome"])


@query(
    "his_durations",
    f"""{roles.history_ctes()}
        SELECT id, nome, "siglaPartido", data_inicio, data_fim, is_current,
               CAST(datediff('day', data_inicio, coalesce(data_fim, DATE '{LAST}')) AS INTEGER) AS dias
        FROM h2 WHERE id IN (SELECT id FROM h2 GROUP BY id HAVING count(*) > 1)
        ORDER BY nome, data_inicio DESC, id LIMIT 20""",
    text=_DATES,
)
def his_durations(spark, sf):
    return history.version_durations(
        roles.entity_history(spark, sf), "id", ["nome", "siglaPartido"], LAST
    )


# Append and overwrite loads -------------------------------------------------------------

_OLD = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate <= DATE '2000-12-31'"
_BATCH = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
            WHERE o_orderdate >= DATE '1999-01-01'"""


def _target_and_batch(spark, sf):
    """Orders up to the end of 2000, and a batch from 1999 on with one more column."""
    orders = table(spark, sf, "orders")
    base = ["o_orderkey", "o_custkey", "o_totalprice"]
    old = orders.where(F.col("o_orderdate") <= F.lit("2000-12-31").cast("timestamp_ntz"))
    batch = orders.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return old.select(base), batch.select(*base, "o_orderpriority")


@query(
    "load_append_all",
    f"SELECT * FROM (SELECT *, NULL AS o_orderpriority FROM ({_OLD})) UNION ALL {_BATCH}",
)
def load_append_all(spark, sf):
    return loads.append_all(*_target_and_batch(spark, sf))


@query(
    "load_append_new",
    f"""SELECT *, NULL AS o_orderpriority FROM ({_OLD})
        UNION ALL SELECT * FROM ({_BATCH}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_OLD}))""",
)
def load_append_new(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return loads.append_new(target, batch, ["o_orderkey"])


_TERM_ROWS = """SELECT year(o_orderdate) AS id, 'http://example.org/' || year(o_orderdate) AS url,
                make_date(year(o_orderdate), 1, 1) AS "dataInicio",
                CAST(max(o_orderdate) AS DATE) AS "dataFim" FROM orders GROUP BY year(o_orderdate)"""


@query("load_static", _TERM_ROWS, text=["dataInicio", "dataFim"])
def load_static(spark, sf):
    """Terms written twice through the store: the second load replaces the first."""
    by_year = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("id"))
    raw = by_year.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("dataFim")).select(
        "id",
        F.concat(F.lit("http://example.org/"), F.col("id")).alias("uri"),
        F.concat(F.col("id"), F.lit("-01-01")).alias("dataInicio"),
        "dataFim",
    )
    store = TableStore(spark, scratch_path(spark, "static"))
    for _ in range(2):
        store.overwrite("legislaturas", cleaning.clean_terms(raw), as_of=LAST)
    return store.read("legislaturas")


# Audit ----------------------------------------------------------------------------------


@query(
    "aud_table_counts",
    f"""{roles.history_ctes(roles.DAYS[:2])}
        SELECT 'entidades' AS tabela, count(*) AS total, count(*) FILTER (is_current) AS ativos,
               'SCD Type 2' AS estrategia, 'ok' AS situacao FROM h1
        UNION ALL SELECT 'pedidos', count(*), NULL, 'APPEND', 'ok' FROM orders
        UNION ALL SELECT 'regioes', count(*), NULL, 'OVERWRITE', 'ok' FROM region
        UNION ALL SELECT 'ausente', NULL, NULL, 'APPEND', 'error'""",
)
def aud_table_counts(spark, sf):
    return loads.load_audit(
        spark,
        {
            "entidades": (roles.entity_history(spark, sf, roles.DAYS[:2]), "SCD Type 2"),
            "pedidos": (table(spark, sf, "orders"), "APPEND"),
            "regioes": (table(spark, sf, "region"), "OVERWRITE"),
            "ausente": (None, "APPEND"),
        },
    )


_LOGGED = """(SELECT count(*) FROM {h} WHERE data_inicio = DATE '{d}'),
               (SELECT count(*) FROM {h} WHERE data_fim = DATE '{d}'),
               (SELECT count(*) FROM {h} WHERE is_current AND data_inicio < DATE '{d}'), '{d}'"""


@query(
    "aud_load_log",
    f"""{roles.history_ctes()}
        SELECT 1 AS version, 'first' AS operation, (SELECT count(*) FROM h0) AS rows_inserted,
               0 AS rows_closed, 0 AS rows_kept, '{FIRST}' AS as_of
        UNION ALL SELECT 2, 'scd2', {_LOGGED.format(h="h1", d=SECOND)}
        UNION ALL SELECT 3, 'scd2', {_LOGGED.format(h="h2", d=LAST)}""",
    text=["as_of"],
)
def aud_load_log(spark, sf):
    """Three loads of the entities, as the store logged them."""
    store = TableStore(spark, scratch_path(spark, "audited"))
    for day in roles.DAYS:
        store.load_scd2("entidades", roles.stamped(spark, sf, day), ["id"], as_of=day)
    return store.load_history("entidades").select(
        "version", "operation", "rows_inserted", "rows_closed", "rows_kept", "as_of"
    )
