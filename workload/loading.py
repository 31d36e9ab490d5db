"""Large documents, types found and widened, loads that write what they touch, kept keys, counts, rejects and places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.operators import cleaning, keys, loads, promotion
from chronomart.operators.ranks import with_positions
from chronomart.plans import buckets, silver
from chronomart.plans.entities import ENTITIES
from chronomart.plans.store import TableStore
from chronomart.session import materialise, scratch_path
from chronomart.sources import envelopes, inference, splitting
from chronomart.streaming.drops import load_arrivals
from workload import roles
from workload.paging import ORDER, order_envelopes
from workload.registry import query, table
from workload.star import raw_expenses, raw_votes

# One document of any size ---------------------------------------------------------------

LINE = (
    T.StructType()
    .add("pedido", "long")
    .add("linha", "long")
    .add("detalhe", T.StructType().add("situacao", "string").add("nota", "string"))
)


def line_document(spark, sf):
    """All line items as records of one JSON document in one file; texts hold braces, quotes and backslashes."""
    path = scratch_path(spark, "document")
    lines = table(spark, sf, "lineitem")
    record = F.to_json(
        F.struct(
            F.col("l_orderkey").alias("pedido"),
            F.col("l_linenumber").alias("linha"),
            F.struct(
                F.col("l_returnflag").alias("situacao"),
                F.concat(F.lit('}] "dados": [{\\ '), F.col("l_linestatus")).alias("nota"),
            ).alias("detalhe"),
        )
    )
    # The document is what would be delivered; a single task writes it, the records' text is made by all.
    some = F.shiftright(F.monotonically_increasing_id(), 10)
    parts = lines.select(record.alias("json"), some.alias("part")).groupBy("part").agg(F.collect_list("json").alias("json"))
    parts = parts.select(F.array_join("json", "\n,").alias("json")).repartition(1)
    numbered = parts.withColumn("at", F.monotonically_increasing_id())
    opening = F.when(F.col("at") == 0, '{"links": [{"rel": "self"}], "dados": [').otherwise(",")
    body = numbered.select(F.concat(opening, "json").alias("value"))
    end = spark.range(1).select(F.lit('], "total": {"paginas": 1}}').alias("value"))
    body.unionByName(end).coalesce(1).write.option("compression", "none").text(path)
    return path


@query(
    "src_envelope_split",
    """SELECT l_orderkey AS pedido, l_linenumber AS linha, l_returnflag AS situacao,
              '}] "dados": [{\\ ' || l_linestatus AS nota FROM lineitem""",
)
def src_envelope_split(spark, sf):
    """Every line item out of one document, which many tasks read."""
    found = splitting.read_split_envelopes(spark, line_document(spark, sf), LINE, glob="*")
    return found.select("pedido", "linha", "detalhe.situacao", "detalhe.nota")


# Types ----------------------------------------------------------------------------------


def _mixed_records(spark, sf):
    """Orders as records of three shapes: fields change their kind and come and go."""
    orders = table(spark, sf, "orders")
    shape = F.col("o_orderkey") % 3
    whole = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.floor("o_totalprice").alias("valor"),
            F.col("o_custkey").alias("cliente"),
            F.struct(F.col("o_orderstatus").alias("situacao")).alias("estado"),
        )
    )
    exact = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("valor"),
            F.concat(F.lit("C-"), F.col("o_custkey")).alias("cliente"),
            F.struct(F.col("o_orderpriority").alias("prioridade")).alias("estado"),
        )
    )
    sparse = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.array(F.col("o_custkey")).alias("clientes")))
    record = F.when(shape == 0, whole).when(shape == 1, exact).otherwise(sparse)
    path = scratch_path(spark, "mixed")
    envelope = F.concat(F.lit('{"dados": ['), record, F.lit("]}"))
    orders.select(envelope.alias("value")).write.option("compression", "none").text(path)
    return path


@query(
    "src_infer_types",
    """SELECT o_orderkey AS id,
              CAST(CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN CAST(o_totalprice AS DECIMAL(12,2)) END
                   AS DOUBLE) AS valor,
              CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN 'C-' || o_custkey END AS cliente,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS situacao,
              CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS prioridade,
              CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS cliente_1 FROM orders""",
)
def src_infer_types(spark, sf):
    """Numbers widen to a decimal, numbers and words to text, structs to the union of their fields."""
    found = inference.read_inferred(spark, _mixed_records(spark, sf), multi_line=False, glob="*")
    return found.select(
        "id", F.col("valor").cast("double").alias("valor"), "cliente", "estado.situacao", "estado.prioridade",
        F.col("clientes")[0].alias("cliente_1"),
    )


_EARLY = "o_orderdate < DATE '1998-01-01'"


@query(
    "load_append_widen",
    f"""SELECT o_orderkey AS id, CASE WHEN {_EARLY} THEN CAST(floor(o_totalprice) AS DECIMAL(22,2))
              ELSE CAST(o_totalprice AS DECIMAL(22,2)) END AS valor,
              CASE WHEN {_EARLY} OR o_orderpriority <> '5-LOW' THEN o_custkey END AS cliente,
              CASE WHEN {_EARLY} THEN o_orderdate ELSE date_trunc('hour', o_orderdate + INTERVAL 5 HOUR) END AS dia,
              CASE WHEN NOT ({_EARLY}) THEN o_orderpriority END AS prioridade,
              CASE WHEN NOT ({_EARLY}) AND o_orderpriority = '5-LOW' THEN 'C-' || o_custkey END AS rejeitado
        FROM orders""",
    text=["valor", "dia"],
)
def load_append_widen(spark, sf):
    """A later load brings decimals for whole numbers, moments for days, and words among the customers' numbers."""
    orders = table(spark, sf, "orders")
    early = F.expr(_EARLY)
    customer = F.col("o_custkey").cast("string")
    target = orders.where(early).select(
        F.col("o_orderkey").alias("id"),
        F.floor("o_totalprice").cast("int").alias("valor"),
        F.col("o_custkey").cast("long").alias("cliente"),
        F.col("o_orderdate").cast("date").alias("dia"),
    )
    batch = orders.where(~early).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("valor"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("C-"), customer)).otherwise(customer).alias("cliente"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 5 HOUR")).alias("dia"),
        F.col("o_orderpriority").alias("prioridade"),
    )
    out = promotion.append_widened(target, batch, {"valor": "decimal(22,2)"})
    return out.select(
        "id", "valor", F.col("cliente").cast("long").alias("cliente"), F.col("dia").cast("timestamp_ntz").alias("dia"),
        "prioridade", F.col(promotion.REJECTED)["cliente"].alias("rejeitado"),
    )


# Loads ----------------------------------------------------------------------------------

_ALL = ", ".join(f'"{c}"' for c in [*roles.ENTITY_COLUMNS, *roles.HISTORY])


@query("load_scd2_touched", f"{roles.history_ctes()} SELECT {_ALL} FROM h2", text=["data_inicio", "data_fim"])
def load_scd2_touched(spark, sf):
    """Three loads of a history laid out by key hash; each rewrites the partitions it touches."""
    path = scratch_path(spark, "buckets")
    snapshots = [(roles.stamped(spark, sf, day), day) for day in roles.DAYS]
    return buckets.load_all(spark, path, snapshots, ["id"], buckets=16).select(*roles.ENTITY_COLUMNS, *roles.HISTORY)


@query(
    "load_arrivals_facts",
    """SELECT l_linestatus AS descricao, l_returnflag AS fornecedor, CAST(l_linenumber AS DECIMAL(18,2)) AS "valorDocumento"
       FROM lineitem""",
    text=["valorDocumento"],
)
def load_arrivals_facts(spark, sf):
    """Facts without a key that arrive in three deliveries of files, most of them equal to others: each is loaded once, and
    a run without new files, or under a new checkpoint, adds nothing."""
    store = TableStore(spark, scratch_path(spark, "arrivals"))
    folder, seen = scratch_path(spark, "drop"), scratch_path(spark, "seen")
    lines = table(spark, sf, "lineitem")
    record = F.struct(
        F.col("l_linestatus").alias("descricao"),
        F.col("l_returnflag").alias("fornecedor"),
        F.col("l_linenumber").cast("string").alias("valorDocumento"),
    )
    envelope = F.to_json(F.struct(F.array(record).alias("dados"))).alias("value")
    for delivery in range(3):
        part = lines.where(F.pmod("l_orderkey", F.lit(3)) == delivery).select(envelope)
        written = part.write.mode("append").option("compression", "none").option("lineSep", "\n")
        written.format("text").save(f"{folder}/{delivery}.json")
        load_arrivals(spark, store, "despesas", f"{folder}/*.json", roles.DAYS[-1], seen, multi_line=False, glob="*")
    load_arrivals(spark, store, "despesas", f"{folder}/*.json", roles.DAYS[-1], f"{seen}-again", multi_line=False, glob="*")
    return store.read("despesas").select("descricao", "fornecedor", "valorDocumento")


_TWICE = """
    SELECT 'partidos' AS familia, 1 AS corrida, count(*) FILTER (c_custkey % 2 = 0) AS inseridas, 0 AS fechadas,
           count(*) FILTER (c_custkey % 2 = 0) AS linhas FROM customer
    UNION ALL SELECT 'partidos', 2, count(*) FILTER (c_custkey % 2 = 1 OR c_custkey % 10 = 0),
           count(*) FILTER (c_custkey % 10 = 0), count(*) + count(*) FILTER (c_custkey % 10 = 0) FROM customer
    UNION ALL SELECT 'partidos', 3, 0, 0, count(*) + count(*) FILTER (c_custkey % 10 = 0) FROM customer
    UNION ALL SELECT 'despesas', 1, count(*) FILTER (l_linenumber <= 3), 0, count(*) FILTER (l_linenumber <= 3) FROM lineitem
    UNION ALL SELECT 'despesas', 2, count(*) FILTER (l_linenumber > 3), 0, count(*) FROM lineitem
    UNION ALL SELECT 'despesas', 3, 0, 0, count(*) FROM lineitem"""


@query("load_run_twice", _TWICE)
def load_run_twice(spark, sf):
    """Three runs of a history family and of an append family: a first one, one with changes, and the same again."""
    store = TableStore(spark, scratch_path(spark, "runs"))
    customers, lines = table(spark, sf, "customer"), table(spark, sf, "lineitem")
    changed = F.when(F.col("c_custkey") % 10 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))

    def parties(run):
        shown = customers.where("c_custkey % 2 = 0") if run == 1 else customers
        name = F.col("c_name") if run == 1 else changed
        return shown.select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("sigla"), name.alias("nome"),
            F.concat(F.lit("http://example.org/"), F.col("c_custkey")).alias("uri"),
        )

    def expenses(run):
        shown = lines.where("l_linenumber <= 3") if run == 1 else lines
        return shown.select(
            F.col("l_linestatus").alias("descricao"), F.lit("2020-01-01T00:00:00").alias("dataEmissao"),
            *(F.col("l_linenumber").cast("string").alias(c) for c in ("valorDocumento", "valorGlosa", "valorLiquido")),
        )

    out = []
    for family, raw in (("partidos", parties), ("despesas", expenses)):
        for run, day in enumerate(roles.DAYS, 1):
            counts = silver.run_load(store, family, raw(run), day)
            lines_held = store.read(family).agg(F.count("*").alias("linhas"))
            told = [F.lit(family).alias("familia"), F.lit(run).alias("corrida"), F.lit(counts["insert"]).cast("long").alias("inseridas"),
                    F.lit(counts["close"]).cast("long").alias("fechadas")]
            out.append(lines_held.select(*told, "linhas"))
    return reduce(DataFrame.unionByName, out)


# Files and pages ------------------------------------------------------------------------


def _as_json_files(spark, folders, path):
    """The text files below ``folders`` as ``<name>-<last part of the folder's name>.json`` in ``path``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folders}/part-*")):
        part = status.getPath()
        folder = part.getParent().getName().rpartition("=")[2]
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(target, f"{part.getName()}-{folder}.json"))


@query(
    "src_year_files",
    """SELECT o_orderkey AS id, o_custkey AS cliente FROM orders
       WHERE o_orderstatus <> 'P' AND year(o_orderdate) BETWEEN 1996 AND 2000""",
)
def src_year_files(spark, sf):
    """The five years up to 2000, out of files named ``<name>-<year>.json``."""
    folders, path = scratch_path(spark, "by-year"), scratch_path(spark, "year-files")
    order_envelopes(spark, sf).write.partitionBy("year").option("compression", "none").text(folders)
    _as_json_files(spark, f"{folders}/year=*", path)
    found = envelopes.read_year_window(spark, path, ORDER, 2000, years=5, multi_line=False)
    return found.select("id", "cliente")


#: Records in a page.
PER_PAGE = 500


def _paged(lines, record, by=()):
    """Pages of records in the order of their id, each naming a next one."""
    placed = with_positions(lines, ["id"], within=by, name="at")
    page = (F.floor((F.col("at") - 1) / PER_PAGE) + 1).cast("int").alias("page")
    held = placed.groupBy(*by, page).agg(F.collect_list(record).alias("dados"))
    return held.select(*by, "page", F.lit(200).alias("status"), "dados", F.array(F.struct(F.lit("next").alias("rel"))).alias("links"))


_ITEM = "l_orderkey * 10 + l_linenumber AS id, l_returnflag AS situacao FROM lineitem"


@query(
    "src_both_ways",
    f"""SELECT 'eventos, arquivos' AS via, CAST(NULL AS BIGINT) AS frente, {_ITEM}
        UNION ALL SELECT 'eventos, paginas', NULL, {_ITEM}
        UNION ALL SELECT 'frentes_deputados, paginas por frente', l_suppkey, {_ITEM} JOIN supplier ON s_suppkey = l_suppkey
               WHERE s_suppkey % 7 <> 0
        UNION ALL SELECT 'proposicoes, uma pagina por ano', NULL, {_ITEM}""",
)
def src_both_ways(spark, sf):
    """Families read in other ways than their usual one: events as files and as pages, members per group, bills by year."""
    lines = materialise(
        table(spark, sf, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_suppkey").alias("id_frente"),
            F.col("l_returnflag").alias("situacao"),
        ),
        "lines",
    )
    record = F.struct("id", "situacao")
    folder, path = scratch_path(spark, "events"), scratch_path(spark, "event-files")
    envelope = F.to_json(F.struct(F.array(record).alias("dados"))).alias("value")
    lines.select(envelope).write.option("compression", "none").text(folder)
    _as_json_files(spark, folder, path)
    files = silver.read_files(spark, ENTITIES["eventos"], path, None, multi_line=False)

    everything = _paged(lines, record)
    events = silver.read_pages(ENTITIES["eventos"], everything)
    groups = table(spark, sf, "supplier").where("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("id"))
    members = silver.read_pages(ENTITIES["frentes_deputados"], _paged(lines, record, ["id_frente"]), groups)
    yearly = everything.select(F.col("page").alias("year"), F.lit(1).alias("page"), "status", "dados", "links")
    bills = silver.read_pages(ENTITIES["proposicoes"], yearly)

    none = F.lit(None).cast("long")
    ways = {
        "eventos, arquivos": files.select(none.alias("frente"), "id", "situacao"),
        "eventos, paginas": events.select(none.alias("frente"), "id", "situacao"),
        "frentes_deputados, paginas por frente": members.select(F.col("id").alias("frente"), F.col("iddeputado").alias("id"), "situacao"),
        "proposicoes, uma pagina por ano": bills.select(none.alias("frente"), "id", "situacao"),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(via).alias("via"), "*") for via, df in ways.items()])


# Kept keys ------------------------------------------------------------------------------

_TYPE_KEYS = """
    WITH v AS (SELECT DISTINCT p_name AS tipo, p_partkey % 2 AS carga FROM part),
      a AS (SELECT DISTINCT tipo FROM v WHERE carga = 0),
      k1 AS (SELECT tipo, row_number() OVER (ORDER BY tipo) AS tipo_id FROM a),
      k2 AS (SELECT tipo, (SELECT count(*) FROM k1) + row_number() OVER (ORDER BY tipo) AS tipo_id
             FROM (SELECT DISTINCT tipo FROM v WHERE carga = 1 AND tipo NOT IN (SELECT tipo FROM a)))"""


@query("dim_keys_kept", f"{_TYPE_KEYS} SELECT tipo, tipo_id FROM k1 UNION ALL SELECT tipo, tipo_id FROM k2")
def dim_keys_kept(spark, sf):
    """Keys of two loads: dense, and those of the first load stay."""
    part = table(spark, sf, "part").select(F.col("p_name").alias("tipo"), (F.col("p_partkey") % 2).alias("carga"))
    first = materialise(keys.extend_keys(None, part.where("carga = 0"), "tipo", "tipo_id"), "keys")
    return keys.extend_keys(first, part, "tipo", "tipo_id")


# Counts and rejects ---------------------------------------------------------------------


@query(
    "aud_observed",
    f"""{roles.history_ctes(roles.DAYS[:2])}
        SELECT 'entidades' AS tabela, count(*) AS total, count(*) FILTER (is_current) AS ativos,
               'SCD Type 2' AS estrategia, 'ok' AS situacao FROM h1
        UNION ALL SELECT 'pedidos', count(*), NULL, 'APPEND', 'ok' FROM orders
        UNION ALL SELECT 'regioes', count(*), NULL, 'OVERWRITE', 'ok' FROM region
        UNION ALL SELECT 'vazia', 0, NULL, 'APPEND', 'ok'
        UNION ALL SELECT 'ausente', NULL, NULL, 'APPEND', 'error'""",
)
def aud_observed(spark, sf):
    """The audit's lines from the jobs that wrote the tables."""
    orders = table(spark, sf, "orders")
    tables = {
        "entidades": (roles.entity_history(spark, sf, roles.DAYS[:2]), "SCD Type 2"),
        "pedidos": (orders, "APPEND"),
        "regioes": (table(spark, sf, "region"), "OVERWRITE"),
        "vazia": (orders.where("o_orderkey < 0"), "APPEND"),
        "ausente": (None, "APPEND"),
    }
    return loads.audited_loads(spark, scratch_path(spark, "audited"), tables)


@query(
    "clean_rejects",
    """SELECT 'votacoes' AS tabela, event_id AS registro, 'dataHoraRegistro' AS campo, '' AS texto
       FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'votacoes', event_id, 'ultimaApresentacaoProposicao_dataHoraRegistro',
              strftime(ts, '%Y-%m-%dT%H:%M') FROM events
       UNION ALL SELECT 'despesas', l_orderkey, 'dataEmissao', 'sem data' FROM lineitem WHERE l_returnflag = 'R'""",
)
def clean_rejects(spark, sf):
    """What cleaning votes and expenses made null, out of the pass that cleaned them."""
    votes = cleaning.with_rejects(cleaning.clean_votes, raw_votes(spark, sf))
    expenses = cleaning.with_rejects(cleaning.clean_expenses, raw_expenses(spark, sf))
    found = [
        cleaning.rejects(cleaned, ["id"]).select(
            F.lit(name).alias("tabela"), F.col("id").alias("registro"), F.col("field").alias("campo"), F.col("raw").alias("texto")
        )
        for name, cleaned in (("votacoes", votes), ("despesas", expenses))
    ]
    return found[0].unionByName(found[1])


# Places ---------------------------------------------------------------------------------


@query(
    "rank_global",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
              row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS posicao FROM lineitem""",
)
def rank_global(spark, sf):
    """The place of every line item by price, without one task that sees all."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return with_positions(lines, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"], name="posicao")


@query(
    "rank_within",
    """SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (
              PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) AS posicao FROM lineitem""",
)
def rank_within(spark, sf):
    """Places within three keys, each of which holds a large share of all rows."""
    lines = table(spark, sf, "lineitem")
    placed = with_positions(
        lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"),
        ["l_shipdate", "l_orderkey", "l_linenumber"], within=["l_returnflag"], name="posicao",
    )
    return placed.drop("l_shipdate")
