"""Laws of row history, and the cases that are easy to get wrong."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronomart.operators import history, loads, rows

SCHEMA = "id int, part int, a string, b string"
TRACKED = ["a", "b"]
KEYS = ["id", "part"]

row = st.tuples(
    st.integers(0, 3),
    st.one_of(st.none(), st.integers(0, 1)),
    st.one_of(st.none(), st.sampled_from(["x", "y"])),
    st.one_of(st.none(), st.sampled_from(["x", "y"])),
)
snapshots = st.lists(st.lists(row, max_size=6), min_size=2, max_size=4)
quick = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=10 * i)


def reference(snapshot_list, close_missing):
    """Row history in plain Python."""

    def order(r):
        return [(v is not None, v if v is not None else "") for v in r[2:]]

    table = []
    for i, snapshot in enumerate(snapshot_list):
        found = {}
        for r in sorted(snapshot, key=order):
            found.setdefault(r[:2], r)
        for version in table:
            if version["end"] is None:
                new = found.get(version["row"][:2])
                if (new is not None and new[2:] != version["row"][2:]) or (new is None and close_missing):
                    version["end"] = day(i)
        open_keys = {v["row"][:2] for v in table if v["end"] is None}
        for key, r in found.items():
            if key not in open_keys:
                table.append({"row": r, "start": day(i), "end": None})
    return sorted(
        ((*v["row"], v["start"], v["end"], v["end"] is None) for v in table), key=repr
    )


def load(spark, snapshot_list, **options):
    table = None
    for i, snapshot in enumerate(snapshot_list):
        stamped = history.stamp(spark.createDataFrame(snapshot, SCHEMA), TRACKED, day(i))
        if table is None:
            table = history.first_load(stamped, KEYS)
        else:
            table = history.apply_scd2(table, stamped, KEYS, day(i), null_safe=True, **options)
    return table


@quick
@given(snapshots, st.booleans())
def test_history_equals_plain_python(spark, snapshot_list, close_missing):
    found = load(spark, snapshot_list, close_missing=close_missing).drop("_hash").collect()
    assert sorted((tuple(r) for r in found), key=repr) == reference(snapshot_list, close_missing)


@quick
@given(snapshots)
def test_laws(spark, snapshot_list):
    table = load(spark, snapshot_list)
    data = table.collect()
    last = day(len(snapshot_list) - 1)
    again = history.stamp(spark.createDataFrame(snapshot_list[-1], SCHEMA), TRACKED, last)
    repeated = history.apply_scd2(table, again, KEYS, last, null_safe=True).collect()
    assert sorted(map(repr, repeated)) == sorted(map(repr, data))

    by_key = {}
    for r in data:
        by_key.setdefault((r.id, r.part), []).append(r)
    for versions in by_key.values():
        assert sum(v.is_current for v in versions) <= 1
        versions.sort(key=lambda v: (v.data_inicio, v.data_fim or dt.date.max))
        for earlier, later in zip(versions, versions[1:], strict=False):
            assert earlier.data_fim is not None and earlier.data_fim <= later.data_inicio

    today = history.as_of(table, last).collect()
    assert sorted(map(repr, today)) == sorted(map(repr, (r for r in data if r.is_current)))


def table_of(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_null_shift_is_a_change_only_when_nulls_are_marked(spark):
    for mode, versions in [("mark_nulls", 2), ("skip_nulls", 1)]:
        first = history.stamp(table_of(spark, [(1, 1, "x", None)]), TRACKED, day(0), mode)
        second = history.stamp(table_of(spark, [(1, 1, None, "x")]), TRACKED, day(1), mode)
        assert history.apply_scd2(first, second, KEYS, day(1)).count() == versions


def test_unknown_hash_mode(spark):
    with pytest.raises(ValueError):
        history.stamp(table_of(spark, []), TRACKED, day(0), "other")


def test_same_day_change_leaves_an_empty_interval(spark):
    first = history.stamp(table_of(spark, [(1, 1, "x", "x")]), TRACKED, day(0))
    second = history.stamp(table_of(spark, [(1, 1, "y", "x")]), TRACKED, day(0))
    both = history.apply_scd2(first, second, KEYS, day(0))
    assert both.where("data_inicio = data_fim").count() == 1
    assert [r.a for r in history.as_of(both, day(0)).collect()] == ["y"]


def test_upgrade_hashes_as_a_load_does(spark):
    plain = table_of(spark, [(1, 1, "x", None), (2, 1, "y", "x")])
    upgraded = history.upgrade_to_history(plain, TRACKED, day(0))
    stamped = history.stamp(plain, TRACKED, day(0))
    assert sorted(map(repr, upgraded.collect())) == sorted(map(repr, stamped.collect()))
    applied = history.apply_scd2(upgraded, history.stamp(plain, TRACKED, day(1)), KEYS, day(1))
    assert applied.count() == 2 and applied.where("NOT is_current").isEmpty()


def test_new_and_missing_columns(spark):
    first = history.stamp(table_of(spark, [(1, 1, "x", "x")]), TRACKED, day(0))
    wider = table_of(spark, [(1, 1, "y", "x"), (2, 1, "x", "x")]).withColumn("c", F.lit("new"))
    found = history.apply_scd2(first, history.stamp(wider, TRACKED, day(1)), KEYS, day(1))
    assert {(r.id, r.a, r.c) for r in found.collect()} == {(1, "x", None), (1, "y", "new"), (2, "x", "new")}


def test_change_summary(spark):
    first = history.stamp(table_of(spark, [(1, 1, "x", "x"), (2, 1, "x", "x")]), TRACKED, day(0))
    second = history.stamp(table_of(spark, [(1, 1, "y", "x"), (3, 1, "x", "x")]), TRACKED, day(1))
    changes = history.snapshot_changes(first, second, KEYS, day(1))
    assert tuple(history.change_summary(changes).first()) == (1, 2, 1, "2 rows applied")
    same = history.snapshot_changes(first, first, KEYS, day(1))
    assert history.change_summary(same).first().message == "no change"


def test_dedupe_survivor_does_not_depend_on_partitioning(spark):
    data = [(i % 3, None if i % 2 else 1, chr(97 + i % 5), None) for i in range(200)]
    results = {
        tuple(sorted(map(repr, rows.dedupe_by_key(table_of(spark, data).repartition(n), KEYS).collect())))
        for n in (1, 3, 8)
    }
    assert len(results) == 1 and len(next(iter(results))) == 6


def test_dedupe_with_map_column(spark):
    df = table_of(spark, [(1, 1, "x", "x"), (1, 1, "x", "y")]).withColumn(
        "m", F.create_map(F.lit("k"), "b")
    )
    assert [r.b for r in rows.dedupe_by_key(df, KEYS).collect()] == ["x"]


def test_append_new_is_idempotent_with_and_without_keys(spark):
    target = table_of(spark, [(1, None, "x", None), (2, 1, "y", "x")])
    batch = table_of(spark, [(1, None, "x", None), (3, 1, None, "x"), (3, 1, None, "x")])
    for keys, rows in ((KEYS, 3), (None, 4)):  # without keys equal rows are facts of their own
        once = loads.append_new(target, batch, keys)
        assert once.count() == rows
        assert loads.append_new(once, batch, keys).count() == rows


def test_merge_update_with_repeated_source_keys(spark):
    target = table_of(spark, [(1, 1, "x", "x"), (2, None, "x", "x"), (4, 1, "x", "x")])
    source = table_of(spark, [(1, 1, "b", "x"), (1, 1, "a", "x"), (2, None, "c", "x")])
    merged = rows.merge_update(target, source, KEYS, {"a": F.col("source.a")}, null_safe=True)
    assert {(r.id, r.a) for r in merged.collect()} == {(1, "a"), (2, "c"), (4, "x")}
    plain = rows.merge_update(target, source, KEYS, {"a": F.col("source.a")})
    assert {(r.id, r.a) for r in plain.collect()} == {(1, "a"), (2, "x"), (4, "x")}


def test_latest_by_on_an_empty_table_gives_no_rows(spark):
    terms = spark.createDataFrame([], "id int, start date")
    df = spark.range(3).where(F.col("id") == rows.latest_by(terms, "id", "start"))
    assert df.isEmpty()


def test_null_keys_have_one_current_row(spark):
    table = None
    for i, value in enumerate("xxy"):
        stamped = history.stamp(spark.createDataFrame([(None, value), (1, value)], "id int, a string"), ["a"], day(i))
        table = history.first_load(stamped, ["id"]) if table is None else history.apply_scd2(table, stamped, ["id"], day(i))
    assert sorted(str(r.id) for r in table.where("is_current").collect()) == ["1", "None"]
    assert table.count() == 4


def test_a_snapshot_older_than_what_it_closes_is_refused(spark):
    rows = lambda v, d: history.stamp(spark.createDataFrame([(1, v)], "id int, a string"), ["a"], d)
    late = history.apply_scd2(rows("x", "2024-05-01"), rows("y", "2024-02-01"), ["id"], "2024-02-01")
    with pytest.raises(Exception, match="older than the version it closes"):
        late.collect()
    same = history.apply_scd2(rows("x", "2024-05-01"), rows("x", "2024-02-01"), ["id"], "2024-02-01")
    assert same.count() == 1
