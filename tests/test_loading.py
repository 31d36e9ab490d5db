"""Types that change between loads, history by buckets, arrivals of facts, kept keys, counts, rejects, places, overlaps."""

import datetime as dt
import itertools
import json
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.operators import cleaning, history, keys, loads, overlap, promotion
from chronomart.operators.ranks import with_positions
from chronomart.plans import buckets
from chronomart.plans.store import TableStore
from chronomart.streaming.drops import load_arrivals


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# Types that change ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "left, right, both",
    [("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("float", "int", "double"),
     ("decimal(30,0)", "decimal(20,10)", "double"), ("date", "timestamp", "timestamp"), ("string", "int", None), ("int", "string", None),
     ("void", "int", "int"), ("array<int>", "int", None), ("date", "int", None)],
)
def test_wider_types(left, right, both):
    found = promotion.wider(T.DataType.fromDDL(left), T.DataType.fromDDL(right))
    assert found == (both and T.DataType.fromDDL(both))


def test_values_that_fit_no_type_stand_beside_their_row(spark):
    target = spark.createDataFrame([(1, 2, "x", dt.date(2024, 1, 1))], "id bigint, n int, s string, d date")
    batch = spark.createDataFrame([("2", 2.5, 7, "2024-02-30", [1]), ("x", 3.0, None, "2024-02-01", None)],
                                  "id string, n double, s int, d string, new array<int>")
    out = promotion.append_widened(target, batch)
    assert dict(out.dtypes) == {"id": "bigint", "n": "double", "s": "string", "d": "date", "new": "array<int>", "_rejected": "map<string,string>"}
    found = {(r.id, r.n, r.s, str(r.d), json.dumps(r._rejected)) for r in out.collect()}
    assert found == {(1, 2.0, "x", "2024-01-01", "null"), (2, 2.5, "7", "None", '{"d": "2024-02-30"}'),
                     (None, 3.0, None, "2024-02-01", '{"id": "x"}')}
    again = promotion.append_widened(out, spark.createDataFrame([("y",)], "n string"))
    assert Counter(json.dumps(r._rejected) for r in again.collect())['{"n": "y"}'] == 1 and again.where("_rejected.id = 'x'").count() == 1


def test_rules_come_first_and_losses_are_told(spark):
    target = spark.createDataFrame([(10**12,), (5,)], "n bigint")
    batch = spark.createDataFrame([(1.5,), (2.0,), (1e300,), (None,)], "n double")
    kept = promotion.append_widened(target, batch, {"n": "bigint"})
    assert Counter((r.n, (r._rejected or {}).get("n")) for r in kept.collect()) == {
        (10**12, None): 1, (5, None): 1, (None, "1.5"): 1, (2, None): 1, (None, "1.0E300"): 1, (None, None): 1}
    text = promotion.append_widened(target, batch, {"n": "string"})
    assert text.where("n = '1.5'").count() == 1 and text.where("_rejected is not null").count() == 0


def test_stored_appends_survive_another_type(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load_append("t", spark.createDataFrame([(1, Decimal("1.5"))], "id bigint, d decimal(5,2)"), "2024-01-01")
    store.load_append("t", spark.createDataFrame([("2", 2.5), ("no", 0.125)], "id string, d double"), "2024-01-02")
    store.load_append("t", spark.createDataFrame([(3,)], "id int"), "2024-01-03")
    assert store.load_append("t", spark.createDataFrame([("no", 0.125)], "id string, d double"), "2024-01-04")["insert"] == 0
    found = {(r.id, r.d and str(r.d), json.dumps(r._rejected, sort_keys=True)) for r in store.read("t").collect()}
    assert found == {(1, "1.50", "null"), (2, "2.50", "null"), (3, None, "null"), (None, None, '{"d": "0.125", "id": "no"}')}


# History by buckets ---------------------------------------------------------------------


def stamped(spark, day, values):
    return history.stamp(spark.createDataFrame(values, "id long, part string, a string"), ["a"], day)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_loads_by_bucket_give_the_history_of_plain_loads(spark, tmp_path):
    rng = random.Random(3)
    plain, path = None, str(tmp_path / "t")
    for i in range(5):
        day = str(dt.date(2024, 1 + i, 1))
        values = [(rng.choice([None, *range(30)]), rng.choice([None, "p"]), rng.choice("xyz")) for _ in range(40)]
        snap = stamped(spark, day, values)
        counts = buckets.load(spark, path, snap, ["id", "part"], day, buckets=8, close_missing=i == 3)
        if plain is None:
            plain = history.first_load(snap, ["id", "part"])
        else:
            summary = history.change_summary(history.snapshot_changes(plain.where("is_current"), snap, ["id", "part"], day, i == 3)).first()
            assert (counts["insert"], counts["close"]) == (summary.inserted, summary.closed)
            plain = history.apply_scd2(plain, snap, ["id", "part"], day, close_missing=i == 3)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
    assert rows_of(buckets.read_history(spark, path), *plain.columns) == rows_of(plain)
    assert rows_of(buckets.read_current(spark, path), *plain.columns) == rows_of(plain.where("is_current"))


def test_a_load_writes_only_partitions_with_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    values = [(i, "p", "x") for i in range(1000)]
    assert buckets.load(spark, path, stamped(spark, "2024-01-01", values), ["id"], "2024-01-01", buckets=50) == {"insert": 1000, "close": 0, "keep": 0}
    before = files(path)
    nothing = buckets.load(spark, path, stamped(spark, "2024-02-01", values), ["id"], "2024-02-01")
    assert nothing == {"insert": 0, "close": 0, "keep": 0} and files(path) == before
    counts = buckets.load(spark, path, stamped(spark, "2024-03-01", [*values[:-1], (999, "p", "y")]), ["id"], "2024-03-01")
    assert (counts["insert"], counts["close"]) == (1, 1) and 0 < counts["keep"] < 60
    after = files(path)
    assert sum(before[f] == after.get(f) for f in before) == 49 and len(after) == 51  # 49 + 1 rewritten + 1 closed
    again = buckets.load(spark, path, stamped(spark, "2024-03-01", [*values[:-1], (999, "p", "y")]), ["id"], "2024-03-01")
    assert again == {"insert": 0, "close": 0, "keep": 0}


def test_a_load_cut_off_between_its_writes_can_be_run_again(spark, tmp_path, monkeypatch):
    path, keys_ = str(tmp_path / "t"), ["id"]
    buckets.load(spark, path, stamped(spark, "2024-01-01", [(i, "p", "x") for i in range(40)]), keys_, "2024-01-01", buckets=4)
    snap = stamped(spark, "2024-02-01", [(i, "p", "x" if i % 3 else "y") for i in range(45)])
    real = buckets._overwrite

    def broken(rows, where, *by):
        if where.endswith("current"):  # one of the partitions is replaced, then the job dies
            one = rows.select("_bucket").distinct().orderBy("_bucket").first()[0]
            real(rows.where(F.col("_bucket") == one), where, *by)
            raise RuntimeError("lost")
        real(rows, where, *by)

    monkeypatch.setattr(buckets, "_overwrite", broken)
    with pytest.raises(RuntimeError):
        buckets.load(spark, path, snap, keys_, "2024-02-01")
    monkeypatch.setattr(buckets, "_overwrite", real)
    buckets.load(spark, path, snap, keys_, "2024-02-01")
    start = stamped(spark, "2024-01-01", [(i, "p", "x") for i in range(40)])
    want = history.apply_scd2(start, snap, keys_, "2024-02-01")
    assert rows_of(buckets.read_history(spark, path), *want.columns) == rows_of(want)


def test_buckets_that_lose_all_rows_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.load(spark, path, stamped(spark, "2024-01-01", [(i, "p", "x") for i in range(9)]), ["id"], "2024-01-01", buckets=5)
    wider = stamped(spark, "2024-02-01", [(3, "p", "z")]).withColumn("extra", F.lit(1))
    buckets.load(spark, path, wider, ["id"], "2024-02-01", close_missing=True)
    current = buckets.read_current(spark, path).collect()
    assert [(r.id, r.a, r.extra) for r in current] == [(3, "z", 1)] and buckets.read_history(spark, path).count() == 10
    with pytest.raises(LookupError):
        buckets.read_current(spark, str(tmp_path / "none"))


# Arrivals of facts ----------------------------------------------------------------------


def test_facts_do_not_depend_on_the_batch_that_brings_them(spark, tmp_path):
    drop, fact = tmp_path / "drop", {"uriProposicao": "http://x/proposicoes/1", "tema": "a"}
    drop.mkdir()
    results = []
    for order in ([["f1", "f2"]], [["f1"], ["f2"]]):
        store = TableStore(spark, str(tmp_path / f"store{len(results)}"))
        folder = drop / str(len(results))
        folder.mkdir()
        for names in order:
            for name in names:
                (folder / f"{name}.json").write_text(json.dumps({"dados": [fact, fact, {**fact, "tema": name}]}))
            load_arrivals(spark, store, "proposicoes_temas", str(folder), "2024-01-01", str(tmp_path / f"seen{len(results)}"))
        # The same files again, and one of them with a record more.
        (folder / "f1.json").write_text(json.dumps({"dados": [fact, fact, fact, {**fact, "tema": "f1"}]}))
        load_arrivals(spark, store, "proposicoes_temas", str(folder), "2024-01-01", str(tmp_path / f"other{len(results)}"))
        results.append(Counter(r.tema for r in store.read("proposicoes_temas").collect()))
    assert results == [Counter({"a": 5, "f1": 1, "f2": 1})] * 2


# Kept keys ------------------------------------------------------------------------------


def test_keys_are_dense_stable_and_never_shared(spark):
    rng = random.Random(5)
    known, seen = None, {}
    for _ in range(4):
        values = [(rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"]) ,) for _ in range(9)]
        known = keys.extend_keys(known, spark.createDataFrame(values, "v string"), "v")
        found = {r.v: r.key for r in known.collect()}
        assert seen.items() <= found.items() and sorted(found.values()) == list(range(1, len(found) + 1))
        assert found.keys() - seen.keys() == {v for v, in values if v} - seen.keys()
        fresh = [v for v in sorted(found, key=found.get) if v not in seen]
        assert fresh == sorted(fresh)
        seen, known = found, spark.createDataFrame(known.collect(), known.schema)
    facts = spark.createDataFrame([("a", 1), (None, 2), ("?", 3)], "v string, n int")
    assert {(r.n, r.key) for r in keys.with_key(facts, known, "v").collect()} == {(1, seen.get("a")), (2, None), (3, None)}


# Places ---------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_places(spark, hot):
    rng = random.Random(hot)
    data = [(None if hot and rng.random() < 0.6 else rng.choice("abc"), rng.choice([None, 1.5, 2.5, rng.random()]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v double, i int").repartition(7)
    ordered = sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2]))
    placed = with_positions(df, [F.col("v").desc_nulls_first(), "i"])
    assert sorted((r.position, r.i) for r in placed.collect()) == [(n, r[2]) for n, r in enumerate(ordered, 1)]
    within = with_positions(df, [F.col("v").desc_nulls_first(), "i"], within=["k"], name="n")
    want, at = {}, Counter()
    for k, _, i in ordered:
        at[k] += 1
        want[i] = at[k]
    assert {r.i: r.n for r in within.collect()} == want


def test_places_of_equal_rows_and_of_none(spark):
    df = spark.range(1000).select(F.lit(1).alias("x"))
    assert sorted(r.position for r in with_positions(df, ["x"]).collect()) == list(range(1, 1001))
    assert sorted(r.position for r in with_positions(df, ["x"], within=["x"]).collect()) == list(range(1, 1001))
    assert with_positions(df.limit(0), ["x"]).count() == with_positions(df.limit(0), ["x"], within=["x"]).count() == 0
    with pytest.raises(ValueError, match="_row"):
        with_positions(df.withColumn("_row", F.lit(1)), ["x"])


# Counts and rejects ---------------------------------------------------------------------


def test_loads_count_in_the_job_that_writes(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(50).select("id", (F.col("id") % 5 == 0).alias("is_current"))
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    found = loads.audited_loads(spark, str(tmp_path), {"t": (df, "SCD Type 2"), "gone": (None, "APPEND")})
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1
    assert rows_of(found) == rows_of(loads.load_audit(spark, {"t": (spark.read.parquet(f"{tmp_path}/t"), "SCD Type 2"), "gone": (None, "APPEND")}))


def test_rejects_come_with_their_record(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-01T10:00:00", "1.5", None, "2"), (2, "x", "1,5", "3", ""), (3, None, None, None, None)],
        "id int, dataEmissao string, valorDocumento string, valorGlosa string, valorLiquido string",
    )
    done = cleaning.with_rejects(cleaning.clean_expenses, raw)
    assert done.drop("_rejects").schema == cleaning.clean_expenses(raw).schema
    assert rows_of(done.drop("_rejects")) == rows_of(cleaning.clean_expenses(raw))
    assert rows_of(cleaning.rejects(done, ["id"])) == [(2, "dataEmissao", "x"), (2, "valorDocumento", "1,5"), (2, "valorLiquido", "")]
    assert done.where("_rejects is null").count() == 2


def test_rejects_of_member_events_and_bills(spark):
    raw = spark.createDataFrame(
        [(1, "n", 5, "u", None, None, "s", "t", "d", [("1",), ("x",)]), (2, "n", 5, "u", None, None, "s", "t", "d", [("1",)])],
        "id_deputado int, nome_deputado string, id int, uri string, dataHoraInicio string, dataHoraFim string, situacao string, "
        "descricaoTipo string, descricao string, orgaos array<struct<id:string>>",
    )
    bad = F.exists("orgaos", lambda o: o["id"].isNotNull() & o["id"].try_cast("int").isNull())
    done = cleaning.with_rejects(cleaning.clean_member_events, raw, {"orgaos": bad})
    ((member, field, text),) = rows_of(cleaning.rejects(done, ["id_deputado"]))
    assert (member, field, json.loads(text)) == (1, "orgaos", {"orgaos": [{"id": "1"}, {"id": "x"}]}) and done.count() == 2


# Overlaps -------------------------------------------------------------------------------


def edges_of(pairs, need):
    members = {}
    for m, g in pairs:
        members.setdefault(g, set()).add(m)
    return {(a, b): n for a, b in itertools.combinations(sorted(members), 2) if (n := len(members[a] & members[b])) >= need}


def long_tailed(seed, groups=120, members=300):
    """A few members are in most groups, most members in a few; some groups are copies of others but for little."""
    rng = random.Random(seed)
    pairs = {(int(members * rng.random() ** 4), g) for g in range(groups) for _ in range(rng.randint(1, 30))}
    pairs |= {(m, g + 1) for m, g in list(pairs) if g % 10 == 0 and rng.random() < 0.9}
    return sorted(pairs)


@pytest.mark.parametrize("need", [1, 2, 5, 9])
def test_all_overlaps(spark, need):
    pairs = long_tailed(need)
    df = spark.createDataFrame(pairs, "_m int, _g int")
    found = {(r._a, r._b): r._w for r in overlap.common_counts(df, need, block_rows=20).collect()}
    assert found == edges_of(pairs, need)


def test_busy_members_do_not_pair_groups(spark):
    """Of a long-tailed input only few of the pairs that share a member are met."""
    rng = random.Random(1)
    pairs = sorted({(m, g) for g in range(400) for m in (rng.sample(range(8), 6) + rng.sample(range(100, 4000), 8))})
    df = spark.createDataFrame(pairs, "_m int, _g int")
    degrees = Counter(m for m, _ in pairs)
    all_met = sum(d * (d - 1) // 2 for d in degrees.values())
    rest = df.join(overlap.busiest_members(df, 6), ["_m", "_g"], "left_anti")
    met = overlap.met_pairs(rest).count()
    assert met * 50 < all_met, (met, all_met)
    found = {(r._a, r._b): r._w for r in overlap.common_counts(df, 7).collect()}
    assert found == edges_of(pairs, 7)


@pytest.mark.parametrize("k", [1, 10, 300])
def test_strongest_edges_without_a_jump(spark, k):
    pairs = long_tailed(7)
    mart = spark.createDataFrame([(m, g, f"g{g}") for m, g in pairs], "iddeputado int, id_frente int, nome_frente string")
    want = sorted(((-n, a, b) for (a, b), n in edges_of(pairs, 2).items()))[:k]
    found = overlap.overlap_edges(mart, min_common=2, k=k).collect()
    assert [(-r.membros_comum, r.frente_1_id, r.frente_2_id) for r in found] == want
    assert all(r.frente_1_nome == f"g{r.frente_1_id}" and r.frente_2_nome == f"g{r.frente_2_id}" for r in found)
