"""Scans, sinks, joins, aggregates, sorts and scalar functions over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions import arrays, hashing, parsing
from chronomart.operators import aggregates, history, loads, membership, rows, star
from chronomart.session import scratch_path
from chronomart.sources import records, tables
from workload import roles
from workload.registry import query, table

# Scans and sinks ------------------------------------------------------------------------


def _saved(spark, df, label, mode="overwrite", name=None, path=None):
    """Save as an external catalog table in the shared folder; returns its name and path."""
    name = name or f"{label}_{uuid.uuid4().hex}"
    path = path or scratch_path(spark, label)
    tables.save_table(df, name, path, mode)
    return name, path


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_table(spark, sf):
    picked = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    name, _ = _saved(spark, picked, "scan")
    return tables.scan_table(spark, name)


@query(
    "snk_parquet",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def snk_parquet(spark, sf):
    path = scratch_path(spark, "bronze")
    tables.write_bronze(
        table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path
    )
    return tables.scan_parquet(spark, path)


@query("snk_overwrite", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def snk_overwrite(spark, sf):
    """A second overwrite with other columns replaces rows and schema of the first."""
    customer = table(spark, sf, "customer")
    name, path = _saved(spark, customer.select("c_custkey", "c_mktsegment"), "overwrite")
    _saved(spark, customer.select("c_custkey", "c_name", "c_acctbal"), "", name=name, path=path)
    return spark.table(name)


@query(
    "snk_append",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linestatus = 'F'
       UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linestatus <> 'F'""",
)
def snk_append(spark, sf):
    lines = table(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    name, path = _saved(spark, lines.where("l_linestatus = 'F'").select(columns), "append")
    rest = lines.where("l_linestatus <> 'F'").select(columns)
    _saved(spark, rest, "", mode="append", name=name, path=path)
    return spark.table(name)


@query(
    "snk_append_evolve",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def snk_append_evolve(spark, sf):
    orders = table(spark, sf, "orders")
    old = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    new = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return loads.append_all(old, new)


@query(
    "view_query",
    "SELECT event_type, count(*) AS num FROM events WHERE value > 10 GROUP BY event_type",
)
def view_query(spark, sf):
    name = f"vw_{uuid.uuid4().hex}"
    table(spark, sf, "events").createOrReplaceTempView(name)
    return spark.sql(
        f"SELECT event_type, count(*) AS num FROM {name} WHERE value > 10 GROUP BY event_type"
    )


@query(
    "dml_update_where",
    """SELECT o_orderkey, CASE WHEN prioridade IS NULL THEN 'unset' ELSE prioridade END AS prioridade,
              CASE WHEN prioridade IS NULL THEN 0 ELSE o_totalprice END AS o_totalprice
       FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prioridade, o_totalprice
             FROM orders)""",
)
def dml_update_where(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prioridade"),
        "o_totalprice",
    )
    return rows.update_where(
        orders,
        F.col("prioridade").isNull(),
        {"o_totalprice": F.lit(0.0), "prioridade": F.lit("unset")},
    )


@query(
    "dml_merge_update",
    """SELECT c.c_custkey, c.c_name,
              CASE WHEN o.total > c.c_acctbal THEN o.total ELSE c.c_acctbal END AS c_acctbal
       FROM customer c LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS total FROM orders
                                  GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
)
def dml_merge_update(spark, sf):
    best = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("total")
    )
    return rows.merge_update(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"),
        best,
        ["c_custkey"],
        {"c_acctbal": F.col("source.total")},
        when=F.col("source.total") > F.col("target.c_acctbal"),
    )


# Joins ----------------------------------------------------------------------------------


@query(
    "join_inner_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, c_name, o_orderstatus
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def join_inner_chain(spark, sf):
    lines, orders, customer = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .select("l_orderkey", "l_linenumber", "l_partkey", "c_name", "o_orderstatus")
    )


@query(
    "join_using",
    """SELECT chave, situacao, linhas, quantidade FROM
         (SELECT l_orderkey AS chave, nullif(l_linestatus, 'F') AS situacao, count(*) AS linhas
          FROM lineitem GROUP BY ALL)
       JOIN (SELECT l_orderkey AS chave, nullif(l_linestatus, 'F') AS situacao,
                    CAST(sum(l_quantity) AS BIGINT) AS quantidade FROM lineitem GROUP BY ALL)
       USING (chave, situacao)""",
)
def join_using(spark, sf):
    """Null key parts never match, so they are dropped."""
    keyed = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("chave"),
        F.nullif("l_linestatus", F.lit("F")).alias("situacao"),
        "l_quantity",
    )
    by = keyed.groupBy("chave", "situacao")
    return by.agg(F.count("*").alias("linhas")).join(
        by.agg(F.sum("l_quantity").cast("bigint").alias("quantidade")), ["chave", "situacao"]
    )


@query(
    "join_delta_detect",
    f"""WITH old AS ({roles.stamped_sql(roles.DAYS[0])}), new AS ({roles.stamped_sql(roles.DAYS[1])})
        SELECT new.id, new.nome, new."siglaPartido", new._hash
        FROM new LEFT JOIN old ON old.id = new.id WHERE old.id IS NULL OR old._hash <> new._hash""",
)
def join_delta_detect(spark, sf):
    old, new = (roles.stamped(spark, sf, d) for d in roles.DAYS[:2])
    return rows.changed_or_new(new, old, ["id"]).select("id", "nome", "siglaPartido", "_hash")


_NULLABLE = "SELECT DISTINCT l_suppkey AS a, nullif(l_linenumber, 1) AS b FROM lineitem"


@query(
    "join_null_safe",
    f"""WITH f AS ({_NULLABLE} WHERE l_linestatus = 'F'), o AS ({_NULLABLE} WHERE l_linestatus = 'O')
        SELECT f.a, f.b FROM f JOIN o ON f.a = o.a AND f.b IS NOT DISTINCT FROM o.b""",
)
def join_null_safe(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("a"),
        F.nullif("l_linenumber", F.lit(1)).alias("b"),
        "l_linestatus",
    )
    f = pairs.where("l_linestatus = 'F'").select("a", "b").distinct().alias("f")
    o = pairs.where("l_linestatus = 'O'").select("a", "b").distinct().alias("o")
    return f.join(o, rows.key_match("f", "o", ["a", "b"], null_safe=True)).select("f.a", "f.b")


@query(
    "join_composite",
    """SELECT o_orderkey, l_linenumber, conta FROM
         (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem) l
       JOIN orders ON l_orderkey = o_orderkey
       JOIN (SELECT DISTINCT o_custkey AS cliente, l_suppkey AS fornecedor,
                    o_custkey + l_suppkey AS conta
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') r
       ON r.cliente = o_custkey AND r.fornecedor = l_suppkey""",
)
def join_composite(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"
    )
    sold = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    returned = (
        sold.where("l_returnflag = 'R'")
        .select(
            F.col("o_custkey").alias("cliente"),
            F.col("l_suppkey").alias("fornecedor"),
            (F.col("o_custkey") + F.col("l_suppkey")).alias("conta"),
        )
        .distinct()
    )
    # Distinct last, on what the join leaves of the lines; dealt out first, as a pair may have very many of them.
    return (
        sold.select("o_orderkey", "l_linenumber", "l_suppkey", "o_custkey")
        .join(
            returned,
            (F.col("o_custkey") == F.col("cliente")) & (F.col("l_suppkey") == F.col("fornecedor")),
        )
        .select("o_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "conta")
        .repartition("o_orderkey", "l_linenumber")
        .distinct()
        .select("o_orderkey", "l_linenumber", "conta")
    )


@query(
    "join_event_date",
    """WITH d AS (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)),
                                                INTERVAL 1 DAY))::DATE AS data FROM events)
       SELECT event_id, data, datediff('day', (SELECT min(data) FROM d), data) AS data_id
       FROM events JOIN d ON CAST(ts AS DATE) = data""",
    text=["data"],
)
def join_event_date(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    days = star.calendar(star.event_bounds(events, "ts", "ts"))
    return star.on_day(events, days, "ts").select("event_id", "data", "data_id")


@query(
    "join_semi_multi_version",
    f"""{roles.history_ctes()}
        SELECT id, nome, "siglaPartido", is_current FROM h2
        WHERE id IN (SELECT id FROM h2 GROUP BY id HAVING count(*) > 1)""",
)
def join_semi_multi_version(spark, sf):
    versions = roles.entity_history(spark, sf)
    return history.version_durations(
        versions, "id", ["nome", "siglaPartido"], roles.DAYS[-1], k=None
    ).select("id", "nome", "siglaPartido", "is_current")


# Aggregates -----------------------------------------------------------------------------


@query(
    "agg_group_count",
    """SELECT l_suppkey, l_returnflag, count(*) AS quantidade FROM lineitem
       GROUP BY l_suppkey, l_returnflag""",
)
def agg_group_count(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(F.count("*").alias("quantidade"))
    )


@query(
    "agg_count_distinct",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS pecas FROM lineitem GROUP BY l_suppkey""",
)
def agg_count_distinct(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count_distinct("l_partkey").alias("pecas"))
    )


@query(
    "agg_sum_squares",
    """SELECT l_suppkey, round(sum(pow(l_discount, 2)), 6) AS soma FROM lineitem GROUP BY l_suppkey""",
)
def agg_sum_squares(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.round(F.sum(F.pow("l_discount", F.lit(2))), 6).alias("soma"))
    )


@query(
    "agg_collect_set",
    """WITH n AS (SELECT l_suppkey, count(*) AS quantidade,
                         CAST(ceil(count(DISTINCT l_partkey) / 1000.0) AS BIGINT) AS partes
                  FROM lineitem GROUP BY 1)
        SELECT DISTINCT l_suppkey, quantidade, partes, l_partkey AS peca FROM lineitem JOIN n USING (l_suppkey)""",
)
def agg_collect_set(spark, sf):
    """The gathered values, taken apart again: their place in the parts is by hash."""
    parts = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    sets = aggregates.collect_in_parts(parts, ["l_suppkey"], "l_partkey", "pecas", True)
    return sets.select("l_suppkey", "quantidade", "partes", F.explode("pecas").alias("peca"))


@query(
    "agg_collect_list",
    """WITH n AS (SELECT l_returnflag, count(*) AS quantidade, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS partes
                  FROM lineitem GROUP BY 1)
        SELECT l_returnflag, quantidade, partes, l_shipdate::DATE::VARCHAR AS dia
        FROM lineitem JOIN n USING (l_returnflag)""",
)
def agg_collect_list(spark, sf):
    days = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_shipdate").cast("date").cast("string").alias("v")
    )
    lists = aggregates.collect_in_parts(days, ["l_returnflag"], "v", "dias", False)
    return lists.select("l_returnflag", "quantidade", "partes", F.explode("dias").alias("dia"))


@query(
    "agg_min_max",
    "SELECT min(l_shipdate) AS primeiro, max(l_shipdate) AS ultimo FROM lineitem",
    text=["primeiro", "ultimo"],
)
def agg_min_max(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.min("l_shipdate").alias("primeiro"), F.max("l_shipdate").alias("ultimo")
    )


@query(
    "agg_having",
    """SELECT o_custkey, count(*) AS pedidos FROM orders GROUP BY o_custkey HAVING count(*) >= 10""",
)
def agg_having(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("pedidos"))
        .where("pedidos >= 10")
    )


@query("agg_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem")
def agg_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber").distinct()


@query(
    "agg_dedupe_key",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_suppkey, l_returnflag, l_quantity) = 1""",
)
def agg_dedupe_key(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity"
    )
    return rows.dedupe_by_key(lines, ["l_orderkey", "l_linenumber"])


@query(
    "agg_share",
    """SELECT l_suppkey, l_returnflag, quantidade, total, round(quantidade / total, 9) AS proporcao
       FROM (SELECT l_suppkey, l_returnflag, count(*) AS quantidade FROM lineitem GROUP BY 1, 2)
       JOIN (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1) USING (l_suppkey)""",
)
def agg_share(spark, sf):
    shares = aggregates.share_of_total(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_returnflag"])
    return shares.withColumn("proporcao", F.round("proporcao", 9))


# Sorts ----------------------------------------------------------------------------------


@query("sort_asc", "SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem ORDER BY l_suppkey")
def sort_asc(spark, sf):
    """The further columns let the range partitioning cut a supplier that has many rows."""
    columns = ["l_suppkey", "l_orderkey", "l_linenumber"]
    return table(spark, sf, "lineitem").select(columns).orderBy(columns)


@query(
    "topk",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def topk(spark, sf):
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
        .limit(20)
    )


@query(
    "sort_latest_scalar",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dia FROM orders
       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    text=["dia"],
)
def sort_latest_scalar(spark, sf):
    orders = table(spark, sf, "orders")
    latest = rows.latest_by(roles.terms(spark, sf), "id", "dataInicio")
    return orders.where(F.year("o_orderdate") == latest).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("dia")
    )


@query(
    "filter_latest_term",
    f"""{roles.membership_ctes()} SELECT id, titulo, "idLegislatura" FROM groups
        WHERE "idLegislatura" = (SELECT id FROM terms ORDER BY "dataInicio" DESC LIMIT 1)""",
)
def filter_latest_term(spark, sf):
    return membership.latest_term(roles.groups(spark, sf), roles.terms(spark, sf)).select(
        "id", "titulo", "idLegislatura"
    )


@query(
    "filter_not_null",
    """SELECT o_orderkey, situacao FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS situacao
       FROM orders) WHERE situacao IS NOT NULL""",
)
def filter_not_null(spark, sf):
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("situacao"))
        .where(F.col("situacao").isNotNull())
    )


# Renames and void columns ---------------------------------------------------------------


@query("clean_rename", "SELECT page_id, url AS endereco FROM pages")
def clean_rename(spark, sf):
    """The second rename names a column that does not exist and changes nothing."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.withColumnRenamed("url", "endereco").withColumnRenamed("uri", "link")


@query(
    "clean_rename_bulk",
    """SELECT o_orderkey AS url, o_custkey AS "urlPartido", o_orderstatus AS "ultimoStatus_data",
              o_orderpriority AS juridico FROM orders""",
)
def clean_rename_bulk(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("uri"),
        F.col("o_custkey").alias("uriPartido"),
        F.col("o_orderstatus").alias("ultimoStatus.data"),
        F.col("o_orderpriority").alias("juridico"),
    )
    return records.rename_by_rule(raw)


@query("clean_drop_void", "SELECT event_id, event_type FROM events")
def clean_drop_void(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.lit(None).alias("vazio"), "event_type")
    return records.drop_void(events)


# Scalar functions -----------------------------------------------------------------------


@query(
    "fn_concat_ws",
    """SELECT o_orderkey, concat_ws('|', o_orderstatus, nullif(o_orderpriority, '5-LOW'),
              CAST(o_custkey AS VARCHAR)) AS partes FROM orders""",
)
def fn_concat_ws(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat_ws(
            "|",
            "o_orderstatus",
            F.nullif("o_orderpriority", F.lit("5-LOW")),
            F.col("o_custkey").cast("string"),
        ).alias("partes"),
    )


_HASHED = ["a", "b", "c"]


@query(
    "fn_row_hash",
    f"""SELECT a, {roles.hash_sql(_HASHED)} AS marcado, {roles.hash_sql(_HASHED, False)} AS sem_nulos
        FROM (SELECT o_orderkey AS a, nullif(o_orderstatus, 'P') AS b,
                     nullif(o_orderpriority, '5-LOW') AS c FROM orders)""",
)
def fn_row_hash(spark, sf):
    named = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("a"),
        F.nullif("o_orderstatus", F.lit("P")).alias("b"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("c"),
    )
    return named.select(
        "a",
        hashing.row_hash(_HASHED).alias("marcado"),
        hashing.row_hash(_HASHED, "skip_nulls").alias("sem_nulos"),
    )


@query(
    "fn_uri_id",
    r"""SELECT page_id, regexp_extract(url, 'en/(\d+)', 1) AS id_en,
               regexp_extract(nullif(regexp_extract(url, 'https://.*'), ''), 'fr/(\d+)', 1) AS id_fr
        FROM pages""",
)
def fn_uri_id(spark, sf):
    secure = F.when(F.col("url").startswith("https://"), F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id",
        parsing.uri_id("url", "en").alias("id_en"),
        parsing.uri_id(secure, "fr").alias("id_fr"),
    )


@query(
    "fn_parse_date",
    """SELECT o_orderkey, CAST(try_strptime(t, '%Y-%m-%d') AS DATE) AS dia FROM
       (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
               ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t FROM orders)""",
    text=["dia"],
)
def fn_parse_date(spark, sf):
    written = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", parsing.parse_date(written).alias("dia"))


_STAMP = "yyyy-MM-dd'T'HH:mm:ss"
_STAMP_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"


@query(
    "fn_parse_ts_strict",
    "SELECT event_id, date_trunc('second', ts) AS momento FROM events",
    text=["momento"],
)
def fn_parse_ts_strict(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        parsing.parse_timestamp_strict(F.date_format("ts", _STAMP)).alias("momento"),
    )


@query(
    "fn_parse_ts_try",
    f"""SELECT event_id, try_strptime(CASE event_type WHEN 'error' THEN 'invalid'
                WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE {_STAMP_SQL} END,
                '%Y-%m-%dT%H:%M:%S') AS momento FROM events""",
    text=["momento"],
)
def fn_parse_ts_try(spark, sf):
    written = (
        F.when(F.col("event_type") == "error", "invalid")
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.date_format("ts", _STAMP))
    )
    return table(spark, sf, "events").select(
        "event_id", parsing.parse_timestamp(written).alias("momento")
    )


@query(
    "fn_parse_ts_default",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('minute', ts)
              ELSE date_trunc('second', ts) END AS momento FROM events""",
    text=["momento"],
)
def fn_parse_ts_default(spark, sf):
    written = (
        F.when(F.col("event_type") == "error", "invalid")
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.date_format("ts", _STAMP))
    )
    return table(spark, sf, "events").select(
        "event_id", parsing.parse_timestamp(written, None).alias("momento")
    )


@query(
    "fn_money_cast",
    """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS valor,
              CAST(l_discount AS DECIMAL(18,2)) AS desconto FROM lineitem""",
    text=["valor", "desconto"],
)
def fn_money_cast(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parsing.to_money("l_extendedprice").alias("valor"),
        parsing.to_money("l_discount").alias("desconto"),
    )


@query(
    "fn_cast_int",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS numero
       FROM lineitem""",
)
def fn_cast_int(spark, sf):
    written = F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).otherwise(
        F.col("l_linenumber").cast("string")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", parsing.to_int(written).alias("numero")
    )


# Arrays and JSON ------------------------------------------------------------------------


@query(
    "arr_explode",
    """SELECT p_partkey, palavra FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS palavra
       FROM part)""",
)
def arr_explode(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.explode(F.split("p_name", " ")).alias("palavra")
    )


@query(
    "arr_transform",
    """SELECT id_evento, descricao, lista FROM (
         SELECT l_orderkey AS id_evento, 'Evento ' || l_orderkey || ' ' || l_linenumber AS descricao,
                unnest([l_linenumber, NULL, CAST(l_quantity AS INTEGER)]) AS lista FROM lineitem)""",
)
def arr_transform(spark, sf):
    """The integers taken from the record array, one per row; text that is none gives null."""
    return roles.raw_member_events(spark, sf).select(
        F.col("id").alias("id_evento"),
        "descricao",
        F.explode(arrays.field_as_int("orgaos")).alias("lista"),
    )


@query(
    "arr_join",
    """SELECT l_orderkey AS id_evento, 'Evento ' || l_orderkey || ' ' || l_linenumber AS descricao,
              CASE WHEN l_quantity <= 40 THEN l_linenumber || ',' || CAST(l_quantity AS INTEGER) END
                AS id_orgaos FROM lineitem""",
)
def arr_join(spark, sf):
    """Nulls inside the array leave no trace; a null array gives null."""
    lines = table(spark, sf, "lineitem")
    ids = F.when(
        F.col("l_quantity") <= 40,
        F.array("l_linenumber", F.lit(None).cast("int"), F.col("l_quantity").cast("int")),
    )
    return lines.select(
        F.col("l_orderkey").alias("id_evento"),
        F.concat_ws(" ", F.lit("Evento"), "l_orderkey", "l_linenumber").alias("descricao"),
        arrays.join_ids(ids).alias("id_orgaos"),
    )


@query(
    "json_parse",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_parse(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", schema)["k"].alias("k")
    )
