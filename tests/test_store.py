"""The table store: what a load writes, what it logs, and what a failed one leaves behind."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronomart.functions.hashing import content_hash
from chronomart.operators.history import stamp
from chronomart.operators.loads import new_rows
from chronomart.sources.tables import write_counted
from chronomart.plans.store import TableStore
from chronomart.session import scratch_path, shared_dir

SCHEMA = "id int, a string"


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "store"))


def df(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def stamped(spark, day, *rows, schema=SCHEMA):
    return stamp(df(spark, *rows, schema=schema), ["a"], day)


def test_scratch_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")


def test_missing_table(store):
    assert not store.exists("t")
    with pytest.raises(LookupError):
        store.read("t")


def test_history_loads(spark, store):
    first = store.load_scd2("t", stamped(spark, "2024-01-01", (1, "x"), (2, "x"), (2, "z")), ["id"], "2024-01-01")
    assert first == {"insert": 2, "close": 0, "keep": 0}
    second = store.load_scd2("t", stamped(spark, "2024-02-01", (1, "y"), (3, "x")), ["id"], "2024-02-01")
    assert second == {"insert": 2, "close": 1, "keep": 1}
    third = store.load_scd2("t", stamped(spark, "2024-03-01", (1, "w")), ["id"], "2024-03-01")
    assert third == {"insert": 1, "close": 1, "keep": 2}

    rows = {(r.id, r.a, str(r.data_inicio), str(r.data_fim), r.is_current) for r in store.read("t").collect()}
    assert rows == {
        (1, "x", "2024-01-01", "2024-02-01", False),
        (1, "y", "2024-02-01", "2024-03-01", False),
        (1, "w", "2024-03-01", "None", True),
        (2, "x", "2024-01-01", "None", True),
        (3, "x", "2024-02-01", "None", True),
    }
    assert {r.id for r in store.read_current("t").collect()} == {1, 2, 3}
    log = store.load_history("t").collect()
    assert [(r.version, r.operation, r.rows_inserted, r.rows_closed) for r in log] == [
        (3, "scd2", 1, 1), (2, "scd2", 2, 1), (1, "first", 2, 0),
    ]
    assert len(store.load_history("t", last=2).collect()) == 2


def test_a_load_that_changes_nothing_is_not_logged(spark, store):
    for day in ("2024-01-01", "2024-02-01", "2024-03-01"):
        counts = store.load_scd2("t", stamped(spark, day, (1, "x")), ["id"], day)
    assert counts == {"insert": 0, "close": 0, "keep": 1}
    assert store.load_history("t").count() == 1


def test_sql_over_registered_tables(spark, store):
    for day, value in [("2024-01-01", "x"), ("2024-02-01", "y")]:
        store.load_scd2("entities", stamped(spark, day, (1, value), (2, "z")), ["id"], day)
    store.register("entities")

    def sql(text):
        return [tuple(r) for r in spark.sql(text).collect()]

    assert sql("SELECT id, a FROM entities WHERE is_current = true ORDER BY id") == [(1, "y"), (2, "z")]
    assert sql("SELECT a FROM entities WHERE id = 1 ORDER BY data_inicio DESC") == [("y",), ("x",)]
    assert sql(
        "SELECT a FROM entities WHERE id = 1 AND data_inicio <= '2024-01-15' "
        "AND (data_fim IS NULL OR data_fim > '2024-01-15')"
    ) == [("x",)]
    assert sql("SELECT id, COUNT(*) AS n FROM entities GROUP BY id HAVING COUNT(*) > 1") == [(1, 2)]
    assert sql(
        "SELECT a, DATEDIFF(COALESCE(data_fim, DATE '2024-02-11'), data_inicio) AS days FROM entities "
        "WHERE id IN (SELECT id FROM entities GROUP BY id HAVING COUNT(*) > 1) ORDER BY data_inicio"
    ) == [("x", 31), ("y", 10)]


def test_files_of_closed_versions_are_not_rewritten(spark, store):
    for i, value in enumerate("abc"):
        day = dt.date(2024, 1 + i, 1)
        store.load_scd2("t", stamped(spark, day, (1, value), (2, "x")), ["id"], day)
    state = store._latest("t")
    assert state["closed"] == ["t/v=000002/_change=close", "t/v=000003/_change=close"]
    assert all("v=000003" in f for f in state["current"])


def test_folders_of_a_failed_load_are_ignored_and_replaced(spark, store):
    store.load_append("t", df(spark, (1, "x")), "2024-01-01")
    junk = df(spark, (9, "junk")).withColumn("_change", F.lit("insert"))
    junk.write.partitionBy("_change").parquet(f"{store.root}/t/v=000002")
    assert [r.id for r in store.read("t").collect()] == [1]
    store.load_append("t", df(spark, (1, "x"), (2, "y")), "2024-01-02")
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2]


def test_appends(spark, store):
    """Without keys equal facts are facts of their own: a batch adds what it has more of."""
    assert store.load_append("t", df(spark, (1, "x"), (1, "x")), "2024-01-01")["insert"] == 2
    assert store.load_append("t", df(spark, (1, "x"), (2, "y")), "2024-01-02")["insert"] == 1
    assert store.load_append("t", df(spark, (1, "x")), "2024-01-03")["insert"] == 0
    assert store.load_append("t", df(spark, (1, "x"), (1, "x"), (1, "x")), "2024-01-03")["insert"] == 1
    assert store.load_append("t", df(spark, (1, "x")), "2024-01-04", only_new=False)["insert"] == 1
    assert sorted(r.id for r in store.read("t").collect()) == [1, 1, 1, 1, 2]


def test_appends_with_keys_add_each_key_once(spark, store):
    assert store.load_append("t", df(spark, (1, "x"), (1, "y")), "2024-01-01", keys=["id"])["insert"] == 1
    assert store.load_append("t", df(spark, (1, "z"), (2, "y"), (2, "y")), "2024-01-02", keys=["id"])["insert"] == 1


def test_append_without_keys_reads_one_column(spark, store):
    store.load_append("t", df(spark, (1, "x")), "2024-01-01")
    known = store.read("t")
    batch = df(spark, (2, "y")).withColumn("_hash", F.lit("h"))
    plan = new_rows(known, batch)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [_hash" in plan


def test_content_hash(spark):
    t = "2024-01-01 00:00:00.00000"
    rows = df(spark, (1, t + "1"), (1, t + "2")).withColumn("ts", F.col("a").cast("timestamp")).drop("a")
    assert rows.select(content_hash(["id", "ts"])).distinct().count() == 2
    wider = rows.select(F.lit(None).cast("int").alias("b"), "ts", "id")
    assert (
        rows.select(content_hash(rows.columns)).collect() == wider.select(content_hash(wider.columns)).collect()
    )


def test_append_with_new_and_missing_columns(spark, store):
    store.load_append("t", df(spark, (1, "x")), "2024-01-01")
    wider = df(spark, (2, "y", 5), schema="id int, a string, c int")
    store.load_append("t", wider, "2024-01-02")
    store.load_append("t", df(spark, (3,), schema="id int"), "2024-01-03")
    found = sorted(tuple(r) for r in store.read("t").select("id", "a", "c").collect())
    assert found == [(1, "x", None), (2, "y", 5), (3, None, None)]
    # A row is known again after the table has gained a column.
    assert store.load_append("t", df(spark, (1, "x")), "2024-01-04")["insert"] == 0


def test_overwrite_replaces_rows_and_schema(spark, store):
    store.overwrite("t", df(spark, (1, "x")), "2024-01-01")
    store.overwrite("t", store.read("t").select(F.col("id").cast("string").alias("k")), "2024-01-02")
    assert store.read("t").dtypes == [("k", "string")] and store.read("t").first().k == "1"


def test_empty_tables_can_be_read(spark, store):
    store.overwrite("t", df(spark), "2024-01-01")
    assert store.read("t").isEmpty() and store.read("t").columns == ["id", "a"]
    assert store.load_append("t", df(spark, (1, "x")), "2024-01-02")["insert"] == 1
    assert store.read("t").count() == 1

def test_copies_of_one_row_are_dealt_out_to_tasks(spark, store, monkeypatch):
    monkeypatch.setattr("chronomart.operators.loads.COPIES", 10)
    store.load_append("t", df(spark, (1, "x"), (1, "x"), (2, "y")), "2024-01-01")
    batch = spark.range(1007).select(F.lit(1).alias("id"), F.lit("x").alias("a"))
    batch = batch.unionByName(df(spark, *[(2, "y")] * 11, *[(3, "z")] * 12))
    rows = new_rows(store.read("t"), batch.withColumn("_hash", content_hash(batch.columns)))
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 2 and max(r["count"] for r in per_task) < 500
    assert store.load_append("t", batch, "2024-01-02")["insert"] == 1005 + 10 + 12
    held = {tuple(r) for r in store.read("t").groupBy("id", "a").count().collect()}
    assert held == {(1, "x", 1007), (2, "y", 11), (3, "z", 12)}


def test_loads_of_one_kind_of_rows_are_written_unsorted(spark, store, monkeypatch):
    written = []

    def counted(rows, path, counts=None, *partitions):
        written.append(partitions)
        return write_counted(rows, path, counts, *partitions)

    monkeypatch.setattr("chronomart.plans.store.write_counted", counted)
    store.load_append("t", df(spark, (1, "x")), "2024-01-01")
    store.load_append("t", df(spark, (2, "y")), "2024-01-02")
    store.overwrite("o", df(spark, (1, "x")), "2024-01-01")
    assert written == [(), (), ()] and store.read("t").count() == 2 and store.read("o").count() == 1
