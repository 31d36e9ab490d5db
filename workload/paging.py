"""Envelopes and pages made from the test tables, and read back by the library."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.plans.store import TableStore
from chronomart.session import scratch_path
from chronomart.sources import envelopes, pages, records
from workload import roles
from workload.registry import query, table

ORDER = (
    T.StructType()
    .add("id", "long")
    .add("cliente", "long")
    .add("ultimoStatus", T.StructType().add("situacao", "string").add("prioridade", "string"))
)


def order_envelopes(spark, sf):
    """One envelope per order, as JSON text, with the order's year."""
    orders = table(spark, sf, "orders")
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cliente"),
        F.struct(
            F.col("o_orderstatus").alias("situacao"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prioridade"),
        ).alias("ultimoStatus"),
    )
    envelope = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.array(record)).alias("dados"),
        F.array(F.struct(F.lit("self").alias("rel"))).alias("links"),
    )
    return orders.select(F.year("o_orderdate").alias("year"), F.to_json(envelope).alias("value"))


_READ = """SELECT o_orderkey AS id, o_custkey AS cliente FROM orders WHERE o_orderstatus <> 'P'"""


@query("src_envelope_dir", _READ)
def src_envelope_dir(spark, sf):
    """Envelopes written one per line; pending orders have no ``dados`` and give no rows."""
    path = scratch_path(spark, "envelopes")
    order_envelopes(spark, sf).select("value").write.option("compression", "none").text(path)
    found = envelopes.read_envelopes(spark, path, ORDER, multi_line=False, glob="*")
    return found.select("id", "cliente")


@query(
    "src_year_window",
    f"""SELECT year(o_orderdate) AS ano, * FROM ({_READ}) JOIN orders ON o_orderkey = id
        WHERE year(o_orderdate) BETWEEN 1996 AND 2000""".replace("*", "id, cliente", 1),
)
def src_year_window(spark, sf):
    """The five years up to 2000, out of folders by year of which the others are not listed."""
    path = scratch_path(spark, "years")
    order_envelopes(spark, sf).write.partitionBy("year").text(path)
    window = envelopes.read_year_partitions(spark, path, ORDER, 2000, years=5, glob="*")
    return window.select(F.col("year").cast("bigint").alias("ano"), "id", "cliente")


@query(
    "src_flatten",
    """SELECT o_orderkey AS id, o_custkey AS cliente, o_orderstatus AS "ultimoStatus_situacao",
              nullif(o_orderpriority, '5-LOW') AS "ultimoStatus_prioridade"
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def src_flatten(spark, sf):
    parsed = envelopes.parse_envelopes(order_envelopes(spark, sf), "value", ORDER)
    return records.flatten_structs(parsed.select(F.inline("dados")))


@query("src_pages", f"{roles.PAGES_CTES} SELECT source, id, quantidade FROM accepted")
def src_pages(spark, sf):
    return pages.collect_pages(roles.page_table(spark, sf))


@query("src_pages_gaps", f"{roles.pages_ctes('(source + page) % 7 <> 0')} SELECT source, id, quantidade FROM accepted")
def src_pages_gaps(spark, sf):
    """Some pages are missing: a reader would not get past the first gap."""
    stored = roles.page_table(spark, sf).where("(source + page) % 7 <> 0")
    return pages.collect_pages(stored)


@query(
    "src_first_page",
    f"""{roles.PAGES_CTES} SELECT source, id, quantidade FROM pages_t
        WHERE page = 1 AND status = 200 AND has_records""",
)
def src_first_page(spark, sf):
    return pages.collect_pages(roles.page_table(spark, sf), first_only=True)


@query(
    "src_child_pages",
    f"""{roles.PAGES_CTES} SELECT source AS id_pedido, o_orderpriority AS nome_pedido, id, quantidade
        FROM accepted JOIN orders ON o_orderkey = source""",
)
def src_child_pages(spark, sf):
    """Pages requested per order, with the order's key and priority written into the records. The parents
    come with history and repeated."""
    listed = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("source"), F.col("o_orderpriority").alias("nome"), F.lit(True).alias("is_current")
    )
    former = listed.select("source", F.lit("former name").alias("nome"), F.lit(False).alias("is_current"))
    parents = listed.unionByName(listed).unionByName(former)
    return pages.collect_child_pages(
        roles.page_table(spark, sf),
        parents,
        "source",
        {"source": "id_pedido", "nome": "nome_pedido"},
    )


@query(
    "src_yearly_gaps",
    f"""{roles.PAGES_CTES} SELECT y.year, count(p.year) AS records, count(p.year) = 0 AS is_empty
        FROM (SELECT unnest(range(1993, 2004)) AS year) y
        LEFT JOIN (SELECT year FROM pages_all WHERE page = 1 AND status = 200 AND has_records) p
        ON p.year = y.year GROUP BY y.year""",
)
def src_yearly_gaps(spark, sf):
    return pages.yearly_gaps(roles.page_table(spark, sf), range(1993, 2004)).withColumn(
        "year", F.col("year").cast("bigint")
    )


FACT = T.StructType().add("pedido", "long").add("linha", "long").add("valor", "double")


def _fact_envelopes(spark, sf, where, path):
    """Line items as records with a field that the declared type lacks, one envelope per line."""
    record = F.struct(
        F.col("l_orderkey").alias("pedido"),
        F.col("l_linenumber").alias("linha"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("valor"),
        F.col("l_returnflag").alias("naoDeclarado"),
    )
    lines = table(spark, sf, "lineitem").where(where)
    lines.select(F.to_json(F.struct(F.array(record).alias("dados"))).alias("value")).write.option(
        "compression", "none"
    ).text(path)
    return envelopes.read_envelopes(spark, path, FACT, multi_line=False, glob="*", whole=True)


@query(
    "load_append_facts",
    """SELECT l_orderkey AS pedido, l_linenumber AS linha, CASE WHEN l_quantity > 25 THEN l_quantity END AS valor,
              '{"naoDeclarado":"' || l_returnflag || '"}' AS _extra
       FROM lineitem""",
)
def load_append_facts(spark, sf):
    """Two overlapping snapshots of facts without a key, many of them equal, loaded through the store:
    every fact is there as often as it is in the larger of both."""
    store = TableStore(spark, scratch_path(spark, "facts"))
    for day, where in (("2000-01-01", "l_shipdate >= DATE '1997-01-01'"), ("2000-01-02", "true")):
        raw = _fact_envelopes(spark, sf, where, scratch_path(spark, "fact-files"))
        store.load_append("fatos", raw, as_of=day)
    return store.read("fatos").select("pedido", "linha", "valor", "_extra")


#: Orders in a file of one envelope, on average.
PER_FILE = 1000


def _order_files(spark, sf):
    """All orders, read from files of one envelope each over several lines, among them one that is broken. The
    number of files grows with the table."""
    path = scratch_path(spark, "files")
    orders = table(spark, sf, "orders")
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("cliente"),
            F.struct(F.col("o_orderstatus").alias("situacao")).alias("ultimoStatus"),
        )
    )
    text = F.concat(F.lit('{"dados": [\n'), F.concat_ws(",\n", F.collect_list(record)), F.lit('\n], "links": []}'))
    n_files = orders.count() // PER_FILE + 1
    files = orders.groupBy(F.pmod(F.xxhash64("o_orderkey"), F.lit(n_files)).alias("n")).agg(text.alias("value"))
    broken = spark.range(1).select(F.lit(-1).cast("long").alias("n"), F.lit('{"dados": [{"id": 1},').alias("value"))
    files.unionByName(broken).write.option("compression", "none").partitionBy("n").text(path)
    return envelopes.read_envelopes(spark, path, ORDER, glob="*")


@query(
    "src_envelope_files",
    "SELECT o_orderkey AS id, o_custkey AS cliente FROM orders WHERE o_orderstatus <> 'P'",
)
def src_envelope_files(spark, sf):
    """The orders that are not pending out of files of one envelope each."""
    return _order_files(spark, sf).where("ultimoStatus.situacao <> 'P'").select("id", "cliente")


@query("src_envelope_files_whole", "SELECT o_orderkey AS id, o_custkey AS cliente FROM orders")
def src_envelope_files_whole(spark, sf):
    """All orders out of files of one envelope each."""
    return _order_files(spark, sf).select("id", "cliente")
