"""What the optimiser makes of the operators, and that no plan leaves the JVM."""

import inspect

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

import workload
from chronomart.operators import history, rows
from chronomart.sources import envelopes
from workload.registry import table

SF = "/root/testdata/sf0.001"
QUERIES = workload.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture(autouse=True)
def restore(spark):
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


WRITERS = {n for n in QUERIES if "scratch_path" in inspect.getsource(workload.registry.ENTRIES[n].run)}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", ["topk", "mart_diversity_top20", "his_durations"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(QUERIES["agg_dedupe_key"](spark, SF))
    partial, exchange = text.index("1, Partial"), text.index("Exchange")
    assert text.count("WindowGroupLimit") == 2 and partial > exchange  # below it in the tree


def test_apply_shuffles_each_side_once(spark):
    no_broadcast(spark)
    for null_safe in (False, True):
        events = table(spark, SF, "events").selectExpr("event_id AS id", "event_type AS a")
        old = history.stamp(events, ["a"], "2024-01-01")
        new = history.stamp(events, ["a"], "2024-02-01")
        text = plan(history.apply_scd2(old, new, ["id"], "2024-02-01", null_safe=null_safe))
        assert text.count("Exchange hashpartitioning") == 2
        assert "FullOuter" in text


def test_delta_detection_reads_keys_and_hash_only(spark):
    events = table(spark, SF, "events").selectExpr("event_id AS id", "event_type AS a", "value")
    old = events.selectExpr("id", "value", "a AS _hash")
    text = plan(rows.changed_or_new(events.selectExpr("id", "a", "value", "a AS _hash"), old, ["id"]))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert any("[event_id" in s and "value" not in s.split("Batched")[0] for s in scans)


def test_latest_term_is_a_subquery_and_filters_before_the_joins(spark):
    text = plan(QUERIES["mart_diversity_top20"](spark, SF))
    assert "Subquery" in text
    assert text.count("Join") <= 8


def test_overlap_condition_stays_an_equi_join(spark):
    no_broadcast(spark)
    text = plan(QUERIES["gra_overlap"](spark, SF))
    assert "CartesianProduct" not in text and "SortMergeJoin" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["load_append_new"](spark, SF))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert all("PushedFilters: [IsNotNull(o_orderdate)" in s for s in scans)
    assert any("o_totalprice" not in s.split("Batched")[0] for s in scans)


def test_year_window_reads_wanted_partitions_only(spark):
    text = plan(QUERIES["src_year_window"](spark, SF))
    assert "PartitionFilters: [year" in text


def test_terms_are_computed_once_by_all_tasks(spark):
    """The texts of a file of one row group are dealt out, and parsed and counted once for lists and their sizes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(QUERIES["txt_term_frequency"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in text and text.count("Generate explode(palavras_chave") == 1
    assert "REPARTITION_BY_COL" in text.split("Generate explode(palavras_chave")[1]


def test_composite_join_removes_copies_of_what_it_keeps_only(spark):
    """Of the lines, the aggregate stands over the join on both keys, not under it with all lines in a task's memory."""
    no_broadcast(spark)
    lines = plan(QUERIES["join_composite"](spark, SF)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join [o_custkey" in line)
    over, under = ([x for x in part if "HashAggregate" in x and "l_linenumber" in x] for part in (lines[:join], lines[join:]))
    assert over and not under


def test_told_fields_of_a_record_are_not_listed_again_for_every_entry(spark):
    record = T.StructType().add("id", "long").add("valor", "double")
    docs = spark.createDataFrame([('[{"id": 1, "valor": "x", "mais": null, "outro": {"a": 2}}, {"id": "y"}]',)], "t string")
    docs = docs.select(F.from_json("t", "array<variant>").alias("dados"))
    found = envelopes.whole_records(docs, record)
    assert "array_except" not in plan(found)
    assert sorted(map(tuple, found.collect()), key=str) == [
        (1, None, '{"outro":{"a":2},"valor":"x"}'), (None, None, '{"id":"y"}'),
    ]


def test_fact_keys_are_computed_before_the_organs_are_listed(spark):
    lines = plan(QUERIES["fact_event"](spark, SF)).splitlines()
    listed = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    over, under = "\n".join(lines[:listed]), "\n".join(lines[listed:])
    assert "md5" in under and "md5" not in over
