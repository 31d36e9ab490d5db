"""One JSON document read by many tasks, and types found while records are staged."""

import json
import random

import pytest
from pyspark.sql import types as T

from chronomart.sources import inference, splitting
from chronomart.sources.splitting import read_split_envelopes, split_records, unreadable_files

RECORD = T.StructType().add("id", "long").add("a", T.StructType().add("b", "string"))


@pytest.fixture(params=[120, 1500, 1 << 20])
def small_splits(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "dados", '"dados":[', "é", "😀", "\n", "\\\\", " ", "x"]) for _ in range(rng.randint(0, 12)))


def value(rng, depth=0):
    kinds = [lambda: rng.randint(-5, 10**6), lambda: text(rng), lambda: None, lambda: rng.random(), lambda: True]
    if depth < 3:
        kinds += [
            lambda: {text(rng) or "k": value(rng, depth + 1) for _ in range(rng.randint(0, 3))},
            lambda: [value(rng, depth + 1) for _ in range(rng.randint(0, 3))],
            lambda: {"dados": [{"id": 1}], "x": value(rng, depth + 1)},
        ]
    return rng.choice(kinds)()


def record(rng):
    return {"id": rng.randint(0, 99), "t": text(rng), "v": value(rng), **({} if rng.random() < 0.5 else {"dados": [{"z": value(rng)}, {}]})}


def document(rng, n):
    parts = [("links", [{"rel": "self"}, {"rel": text(rng)}]), ("dados", [record(rng) for _ in range(n)]), (text(rng), value(rng)),
             ("meta", {"dados": [{"no": 1}], "p": [{"q": {}}]}), ("outros", [{"dados": [{"no": 2}]}, [], {"x": 1}])]
    rng.shuffle(parts)
    return dict(parts)


def written(tmp_path, documents):
    want = {}
    for name, (doc, style) in documents.items():
        (tmp_path / name).write_text(json.dumps(doc, **style), encoding="utf-8")
        want[name] = doc.get("dados") or []
    return want


def test_records_of_awkward_documents(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(splitting, "RUN_BITS", 3)
    rng = random.Random(small_splits)
    styles = [{}, {"indent": 1}, {"ensure_ascii": False}, {"separators": (",", ":")}]
    documents = {f"d{i}.json": (document(rng, rng.choice([0, 1, 2, 9])), styles[i % 4]) for i in range(12)}
    documents |= {"none.json": ({"links": []}, {}), "empty.json": ({"dados": []}, {"indent": 2}), "nothing.json": ({}, {})}
    want = written(tmp_path, documents)
    (tmp_path / "tail.json").write_text('{"dados": [{"id": 5}]}\n \n')
    (tmp_path / "spaced.json").write_text('\n{ "dados"\n:\t[ {"id": 6} , {"id"\n: 7, "a": { } } ] }')
    want |= {"tail.json": [{"id": 5}], "spaced.json": [{"id": 6}, {"id": 7, "a": {}}]}
    found = {name: {} for name in want}
    for r in split_records(spark, str(tmp_path)).collect():
        assert r.record not in found[r.file.rsplit("/", 1)[1]]
        found[r.file.rsplit("/", 1)[1]][r.record] = json.loads(r.json)
    assert {name: [rows[i] for i in range(len(rows))] for name, rows in found.items()} == want


def test_documents_that_do_not_end_are_left_out_and_listed(spark, tmp_path, small_splits):
    bad = {"cut.json": '{"dados": [{"id": 7}, {"id"', "quote.json": '{"dados": [{"id": 7, "t": "x}]}', "more.json": '{"dados": [{"id": 7}]}}',
           "words.json": '{"dados": [{"id": 7}]} and more'}
    for name, content in bad.items():
        (tmp_path / name).write_text(content)
    (tmp_path / "good.json").write_text('{"dados": [{"id": 8, "a": {"b": "x"}}, {"id": "no"}]}')
    assert {r.file.rsplit("/", 1)[1] for r in unreadable_files(spark, str(tmp_path)).collect()} == set(bad)
    rows = read_split_envelopes(spark, str(tmp_path), RECORD, keep=("record",)).orderBy("record").collect()
    assert [(r.record, r.id, r.a and r.a.b) for r in rows] == [(0, 8, "x"), (1, None, None)]


def test_undeclared_fields_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"dados": [{"id": 8, "a": null, "other": {"k": [1, 2]}}]}')
    (row,) = read_split_envelopes(spark, str(tmp_path), RECORD, whole=True).collect()
    assert row.id == 8 and json.loads(row._extra) == {"other": {"k": [1, 2]}}


def test_one_file_is_many_tasks_and_short_rows(spark, tmp_path):
    rows = [{"id": i, "a": {"b": "y" * (i % 50)}} for i in range(20_000)]
    (tmp_path / "one.json").write_text(json.dumps({"dados": rows}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tasks = {}
    try:
        for size in (200_000, 50_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            pieces = splitting._pieces(spark, str(tmp_path), "*.json")
            tasks[size] = pieces.rdd.getNumPartitions()
            assert pieces.selectExpr("max(length(value))").first()[0] < 200
        found = read_split_envelopes(spark, str(tmp_path), RECORD)
        assert sorted((r.id, len(r.a.b)) for r in found.collect()) == [(i, i % 50) for i in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks[200_000] >= 4 and tasks[50_000] >= 3 * tasks[200_000]


def test_no_files_with_records(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert split_records(spark, str(tmp_path)).count() == 0


def staged_rows(monkeypatch):
    """The rows of each table that is staged, by label; of runs that are cut, those with their records."""
    rows, stage = {}, splitting.materialise

    def counted(df, label):
        out = stage(df, label)
        rows.setdefault(label, []).append(out.count() if label != "cut" else out.where("cut IS NOT NULL").count())
        return out

    monkeypatch.setattr(splitting, "materialise", counted)
    return rows


def test_runs_of_records_are_not_scanned_piece_by_piece(spark, tmp_path, monkeypatch):
    rows = [{"id": i, "a": {"b": "}]"}} for i in range(20_000)]
    (tmp_path / "one.json").write_text(json.dumps({"dados": rows}))
    staged = staged_rows(monkeypatch)
    found = split_records(spark, str(tmp_path))
    assert sum(map(sum, staged.values())) < 3_000  # of 60,001 pieces
    assert {r.record: json.loads(r.json) for r in found.collect()} == dict(enumerate(rows))


def test_cut_and_scanned_runs_give_the_same(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(splitting, "RUN_BITS", 2)
    rng = random.Random(small_splits)
    documents = {f"d{i}.json": (document(rng, 40), {"indent": 1} if i % 2 else {}) for i in range(3)}
    other = [1, [2, {"a": [3]}], "x", None, {"id": 4}]
    want = written(tmp_path, documents)
    (tmp_path / "other.json").write_text(json.dumps({"dados": other + [record(rng) for _ in range(20)] + other}))
    staged = staged_rows(monkeypatch)
    cut = {(r.file.rsplit("/", 1)[1], r.record): r.json for r in split_records(spark, str(tmp_path)).collect()}
    assert sum(staged["cut"]) > 20
    assert all(json.loads(cut[name, i]) == r for name, records in want.items() for i, r in enumerate(records))
    monkeypatch.setattr(splitting, "_OBJECT", r'(?s)()["{}\[\]].*+')
    scanned = {(r.file.rsplit("/", 1)[1], r.record): r.json for r in split_records(spark, str(tmp_path)).collect()}
    assert staged["cut"][1:] == [0] and cut == scanned


def test_long_and_deep_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splitting, "RUN_BITS", 3)
    deep = 7
    for i in range(3 * splitting.DEEP):
        deep = {"k": deep} if i % 2 else [deep, {}]
    rows = [{"id": 0}, {"t": '\\"' * 100_000}, {"t": '{"dados": [}' * 100, "l": [{}] * 100}, {"d": deep}, {"t": "}" * 100 + "\\", "d": [deep, 1]}]
    rows = [*rows, *[{"id": i, "o": {}} for i in range(50)]] * 2
    (tmp_path / "a.json").write_text(json.dumps({"x": deep, "dados": rows, "y": deep}))
    (tmp_path / "b.json").write_text('{"dados": [{"id": 1}], "v": \\{"k": 1}}')
    staged = staged_rows(monkeypatch)
    assert {r.record: json.loads(r.json) for r in split_records(spark, str(tmp_path)).collect()} == dict(enumerate(rows))
    assert sum(staged["cut"]) > 20


def test_records_deeper_than_the_pattern(spark, tmp_path):
    deep = 7
    for i in range(2 * splitting.DEEP):
        deep = [deep, "x" * 50]
    rows = [{"id": i, "d": [deep, {}, [{"k": deep}]]} for i in range(3_000)]
    (tmp_path / "a.json").write_text(json.dumps({"dados": rows}))
    found = split_records(spark, str(tmp_path))
    assert {r.record: json.loads(r.json) for r in found.collect()} == dict(enumerate(rows))


# Types ----------------------------------------------------------------------------------


def test_types_widen_and_are_found_in_one_pass(spark, tmp_path):
    records = [
        {"i": 1, "d": 1, "f": 1, "s": 1, "o": {"a": 1}, "m": {"k": 1}, "l": [1], "b": True, "n": None},
        {"i": 2**40, "d": 2.25, "f": 1e300, "s": "x", "o": {"b": "y", "a": 2.5}, "m": "word", "l": ["x"], "b": None, "e": {}},
        {"i": None, "odd name": 3, "back`tick": 4, "l": []},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"dados": records[:1]}) + "\n" + json.dumps({"dados": [*records[1:], 5, None]}))
    df = inference.read_inferred(spark, str(tmp_path), multi_line=False)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["i"] == "bigint" and types["f"] == "double" and types["s"] == types["m"] == types["n"] == types["e"] == "string"
    assert types["d"].startswith("decimal") and types["l"] == "array<string>" and types["b"] == "boolean"
    assert types["odd name"] == types["back`tick"] == "bigint"
    rows = {r["i"]: r.asDict(recursive=True) for r in df.collect()}
    assert len(rows) == 3
    assert float(rows[1]["d"]) == 1 and float(rows[2**40]["d"]) == 2.25 and rows[2**40]["f"] == 1e300
    assert rows[1]["s"] == "1" and rows[2**40]["s"] == "x" and json.loads(rows[1]["m"]) == {"k": 1} and rows[2**40]["m"] == "word"
    assert rows[1]["o"]["b"] is None and rows[2**40]["o"]["b"] == "y" and rows[1]["l"] == ["1"] and rows[None]["odd name"] == 3


def test_types_of_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"dados": []}')
    assert inference.read_inferred(spark, str(tmp_path)).columns == []


def test_records_are_put_together_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"dados": [{"id": 1, "n": {"x": 2}}, {"id": 2}]}')
    found = splitting.split_records(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("/records-") == 2  # within splits, and over borders
    assert sorted(r["record"] for r in found.collect()) == [0, 1]
