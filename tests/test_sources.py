"""Envelopes, pages, records and column names."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.session import scratch_path
from chronomart.sources import envelopes, pages, records, tables

RECORD = T.StructType().add("id", "long").add("a", T.StructType().add("b", "string"))


@pytest.fixture
def folder(tmp_path):
    def write(name, content):
        (tmp_path / name).write_text(content if isinstance(content, str) else json.dumps(content, indent=1))

    write("good-2019.json", {"dados": [{"id": 1, "a": {"b": "x"}}, {"id": 2, "a": None}], "links": []})
    write("more-2024.json", {"dados": [{"id": 3}]})
    write("old-2016.json", {"dados": [{"id": 9}]})
    write("other.json", {"links": []})
    write("empty.json", {"dados": []})
    write("broken.json", '{"dados": [{"id": 7}, {"id"')
    write("notes.txt", "no envelope")
    return str(tmp_path)


def test_only_readable_envelopes_give_rows(spark, folder):
    found = envelopes.read_envelopes(spark, folder, RECORD)
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 9]


def test_unreadable_envelopes_are_listed(spark, folder):
    found = envelopes.unreadable_envelopes(spark, folder, RECORD).collect()
    assert {(r.file.rsplit("/", 1)[1], r.reason) for r in found} == {
        ("broken.json", "not readable as an envelope"),
        ("other.json", "no dados"),
    }


def test_year_window_counts_back_from_the_given_year(spark, folder):
    assert envelopes.year_window(2024) == list(range(2017, 2025))
    found = envelopes.read_year_window(spark, folder, RECORD, 2024)
    assert sorted(r.id for r in found.collect()) == [1, 2, 3]


def test_inferred_record_schema(spark, folder):
    found = envelopes.infer_record_schema(spark, f"{folder}/good-2019.json")
    assert found["id"].dataType == T.LongType() and found["a"].dataType["b"].dataType == T.StringType()


PAGE = "source string, page int, status int, dados array<struct<id:int>>, links array<struct<rel:string>>"
NEXT, LAST = [("self",), ("next",)], [("self",)]


def page(source, number, ids, links=NEXT, status=200):
    return (source, number, status, None if ids is None else [(i,) for i in ids], links)


def walk(rows):
    """The stop rule, page by page."""
    taken = []
    for source in sorted({r[0] for r in rows}):
        for _, _, status, dados, links in sorted(r for r in rows if r[0] == source):
            if status != 200 or not dados:
                break
            taken += [(source, d[0]) for d in dados]
            if not links or not any(x[0] == "next" for x in links):
                break
    return sorted(taken)


ROWS = [
    page("a", 1, [1, 2]), page("a", 2, [3], LAST), page("a", 3, [99]),
    page("b", 1, [4]), page("b", 2, []), page("b", 3, [99]),
    page("c", 1, [5]), page("c", 2, [99], status=500), page("c", 3, [99]),
    page("d", 1, [6]), page("d", 2, [7]),
    page("e", 1, None),
    page("f", 1, [8], None), page("f", 2, [99]),
    page("g", 1, [9], []), page("g", 2, [99]),
]


def test_pages_stop_as_a_reader_would(spark):
    df = spark.createDataFrame(ROWS, PAGE)
    assert sorted(tuple(r) for r in pages.collect_pages(df).collect()) == walk(ROWS)


def test_gaps_and_repeats(spark):
    rows = [
        page("a", 1, [1]), page("a", 3, [99]), page("a", 4, [99]),
        page("b", 2, [99]), page("b", 3, [99]),
        page("c", 1, [2]), page("c", 1, [2]), page("c", 2, [3], LAST), page("c", 2, [3], LAST),
        page("d", 0, [99]), page("d", 1, [4], LAST),
    ]
    df = spark.createDataFrame(rows, PAGE)
    assert sorted(tuple(r) for r in pages.collect_pages(df).collect()) == [("a", 1), ("c", 2), ("c", 3), ("d", 4)]


def test_pages_of_a_single_source(spark):
    rows = [r for r in ROWS if r[0] == "a"]
    df = spark.createDataFrame(rows, PAGE).drop("source")
    assert sorted(r.id for r in pages.collect_pages(df, by=()).collect()) == [1, 2, 3]
    endless = spark.createDataFrame([r for r in ROWS if r[0] == "d"], PAGE).drop("source")
    assert sorted(r.id for r in pages.collect_pages(endless, by=()).collect()) == [6, 7]


def test_first_page_only(spark):
    df = spark.createDataFrame([*ROWS, page("h", 1, [99], status=404)], PAGE)
    found = pages.collect_pages(df, first_only=True).collect()
    assert sorted(tuple(r) for r in found) == sorted(
        (r[0], d[0]) for r in ROWS if r[1] == 1 for d in r[3] or []
    )


def test_child_pages_carry_the_parent(spark):
    df = spark.createDataFrame(ROWS, PAGE)
    parents = spark.createDataFrame([("a", "Ana"), ("c", "Caio")], "source string, nome string")
    found = pages.collect_child_pages(df, parents, "source", {"source": "id_pai", "nome": "nome_pai"})
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", "Ana", 1), ("a", "Ana", 2), ("a", "Ana", 3), ("c", "Caio", 5),
    ]
    assert found.columns == ["id_pai", "nome_pai", "id"]
    bare = pages.collect_child_pages(df, parents, "source", {"source": "id_pai"})
    assert bare.count() == 4


def test_yearly_gaps(spark):
    df = spark.createDataFrame(ROWS, PAGE).withColumn("year", F.ascii("source") - 96)
    found = pages.yearly_gaps(df, [1, 5, 9]).collect()
    assert {tuple(r) for r in found} == {(1, 2, False), (5, 0, True), (9, 0, True)}
    assert sorted(r.year for r in pages.collect_yearly(df).where("year < 3").collect()) == [1, 1, 2]


def test_flatten_keeps_arrays_and_gives_null_for_missing_parts(spark):
    schema = "a struct<b: struct<c: int>>, l array<struct<id: int>>"
    df = spark.createDataFrame([(((5,),), [(7,)]), (None, [])], schema)
    flat = records.flatten_structs(df)
    assert flat.columns == ["a_b_c", "l"]
    assert [(r.a_b_c, len(r.l)) for r in flat.collect()] == [(5, 1), (None, 0)]


def test_names_that_would_collide_are_refused(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b: int>, a_b int")
    with pytest.raises(ValueError):
        records.flatten_structs(df)
    with pytest.raises(ValueError):
        records.rename_by_rule(spark.createDataFrame([(1, 2)], "uri int, URL int"))


def test_rename_rule_takes_leading_uri_only(spark):
    names = ["uri", "uriPartido", "a.b", "juridico", "uris", "status.uriOrgao", "status_uriRelator"]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    assert records.rename_by_rule(df).columns == [
        "url", "urlPartido", "a_b", "juridico", "uris", "status_urlOrgao", "status_urlRelator",
    ]


def test_drop_void(spark):
    df = spark.range(1).withColumn("v", F.lit(None)).withColumn("n", F.lit(None).cast("int"))
    assert records.drop_void(df).columns == ["id", "n"]


def test_bronze_writes_nothing_for_an_empty_result(spark):
    path = scratch_path(spark, "bronze")
    assert tables.write_bronze(spark.range(3), path)
    assert not tables.write_bronze(spark.range(0), path)
    assert tables.scan_parquet(spark, path).count() == 3


def test_catalog_tables(spark):
    tables.ensure_schema(spark, "source_test")
    tables.ensure_schema(spark, "source_test")
    try:
        path = scratch_path(spark, "table")
        tables.save_table(spark.range(3), "source_test.t", path)
        tables.save_table(spark.range(2), "source_test.t", path, mode="append")
        assert tables.scan_table(spark, "source_test.t").count() == 5
        tables.save_table(spark.range(1).selectExpr("'x' AS name"), "source_test.t", path)
        assert tables.scan_table(spark, "source_test.t").columns == ["name"]
    finally:
        spark.sql("DROP DATABASE source_test CASCADE")


def test_order_files_hold_all_orders_in_bounded_files(spark):
    from workload import paging

    sf = "/root/testdata/sf0.01"
    files = paging._order_files(spark, sf).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert len(files) > 5 and max(r["count"] for r in files) < 2 * paging.PER_FILE
