import random

import numpy as np
import pyarrow as pa

from chronomart.llm import ngram_jaccard
from chronomart.llm.components import components
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import documents, edited, frame, prose, words

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, n):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1)))


def brute(rows, n=4, percent=85):
    sets = {}
    for key, text in rows:
        sets.setdefault(key, shingles(text, n))
    keys = sorted(k for k, s in sets.items() if s and k is not None)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                if 100 * len(x & y) >= percent * len(x | y):
                    a_, b_ = find(a), find(b)
                    root[max(a_, b_)] = min(a_, b_)
    return sorted(((k, len(shingles(t, n)), find(k) if k in root else k) for k, t in rows), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_awkward_documents(spark, tmp_path):
    rows = documents()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(QUERIES["op5_ngram_jaccard"](spark, str(tmp_path))) == brute([r[:2] for r in rows])


def test_chains_and_edges_of_the_threshold(spark, monkeypatch):
    """Copies of copies, and copies whose least document is not alike to the others."""
    rng = random.Random(9)
    rows, n = [], 0
    for _ in range(10):
        text = prose(rng, rng.randint(40, 160))
        chain = text
        for _ in range(12):
            chain = edited(rng, chain, rng.randint(0, 3))
            rows.append((n := n + 1, chain))
        for _ in range(12):
            rows.append((n := n + 1, edited(rng, text, rng.randint(1, 5))))
        rows.append((n := n + 1, text))
    monkeypatch.setattr(ngram_jaccard, "TILE", 4)  # many tiles, beside some pairs by join
    monkeypatch.setattr(ngram_jaccard, "FEW", 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (85, 80):
        assert rows_of(ngram_jaccard.linked(docs, 4, percent)) == brute(rows, 4, percent)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op5_ngram_jaccard"](spark, sf)) == brute(rows)


def test_no_rows_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n int")
    assert ngram_jaccard.linked(empty, 4, 85).count() == 0
    docs = spark.createDataFrame([(1, "a b", 3, 4), (2, "A  b", 3, 4)], "doc_id long, text string, doc int, bits int")
    assert rows_of(ngram_jaccard.linked(docs, 4, 85)) == [(1, 1, 1), (2, 1, 1)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1400)] + [(5, 5), (None, 3), (160, 2)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 2 for i in range(100, 161)}, 2: 2, **{i: 7 for i in range(1000, 1400)}, 7: 7}


def test_one_component_is_not_dealt_out_against_itself(spark, monkeypatch):
    """Of many documents under an n-gram only those outside its largest component are copied to the blocks of all."""
    monkeypatch.setattr(ngram_jaccard, "TILE", 10)

    def dealt(parts):
        rows = [(7, doc, part, 50) for doc, part in parts.items()]
        found = ngram_jaccard._dealt_to_tiles(spark.createDataFrame(rows, "gram long, doc long, part long, n long")).collect()
        tiles = {}
        for r in found:
            tiles.setdefault((r.i, r.j), []).append((r.doc, r.side))
        met = [tuple(sorted((a, b))) for t in tiles.values() for a, x in t for b, y in t if (x, y) == (0, 1) or x == y == 2 and a < b]
        assert len(met) == len(set(met)) and max(map(len, tiles.values())) < 60
        return len(found), set(met)

    # 395 documents of one component and five others: 40 blocks of the former.
    parts = {i: 1 for i in range(395)} | {1000 + i: 1000 + i for i in range(5)}
    copies, met = dealt(parts)
    assert copies == 395 + 5 * 41
    assert met == {(a, b) for a in parts for b in parts if a < b and b >= 1000}

    # Two large components, and none at all.
    parts = {i: i % 2 for i in range(60)}
    assert {(a, b) for a in parts for b in parts if a < b and parts[a] != parts[b]} <= dealt(parts)[1]
    assert len(dealt({i: i for i in range(60)})[1]) == 60 * 59 // 2


def test_a_group_of_one_block_is_not_copied(spark):
    """Up to a tile's side of each, the documents outside the largest component meet all in one tile."""
    parts = {i: 1 for i in range(30)} | {100 + i: 100 + i // 2 for i in range(20)}
    rows = [(7, doc, part, 50) for doc, part in parts.items()]
    found = ngram_jaccard._dealt_to_tiles(spark.createDataFrame(rows, "gram long, doc long, part long, n long")).collect()
    assert sorted(r.doc for r in found) == sorted(parts) and {(r.i, r.j) for r in found} == {(0, 0)}
    assert all(r.side == (1 if r.part == 1 else 2) for r in found)


def test_common_grams_are_led_by_the_rarest(spark):
    """Texts of frequent words only are looked up under the least frequent of their n-grams."""
    grams, place = ngram_jaccard.common_order(np.array([5, -3, 9, 2]), np.array([40, 7, 40, 900]))
    assert dict(zip(grams.view(np.int64).tolist(), place.tolist())) == {-3: 1, 5: 2, 9: 3, 2: 4}
    like = ngram_jaccard.Likeness(1, 85)
    sets = like.sets(pa.array(["a b c d e f g"]))[0]
    common = ngram_jaccard.common_order(sets.view(np.int64), np.array([70, 10, 60, 20, 50, 30, 40]))

    class Sent:
        value = common

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f g"])], ["doc", "text"])
    lead = next(ngram_jaccard._features(like, Sent)(iter([batch]))).column(5).to_pylist()[0]
    assert lead == [int(sets.view(np.int64)[i]) for i in (1, 3)]


def test_short_tasks_see_what_is_common():
    like = ngram_jaccard.Likeness(1, 85)
    batch = pa.RecordBatch.from_arrays([pa.array(["often a", "often b", "often c", "often d"])], ["text"])
    assert [b.column(1).to_pylist() for b in ngram_jaccard._common(like)(iter([batch]))] == [[4]]


def test_documents_that_meet_under_many_ngrams_are_paired_once(monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "MARKED", 64)
    like = ngram_jaccard.Likeness(1, 85)
    rng = np.random.default_rng(3)
    held = [np.sort(rng.choice(300, 9, replace=False)) - 150 for _ in range(80)]
    bits = ngram_jaccard._bitmap(np.arange(20, dtype=np.uint64))
    met = []
    for gram in range(-150, 150):
        docs = [d for d in range(80) if gram in held[d]]
        if not docs:
            continue
        n = len(docs)
        tile = pa.table({
            "doc": pa.array(docs, pa.int64()), "part": pa.array(docs, pa.int64()), "n": pa.array([20] * n, pa.int64()),
            "bits": pa.array([bits] * n, pa.binary()), "grams": pa.array([rng.permutation(held[d]) for d in docs], pa.list_(pa.int64())),
            "side": pa.array([2] * n, pa.int32()), "guest": pa.array([False] * n),
        })
        found = ngram_jaccard._tiles(like)((pa.scalar(gram), pa.scalar(0), pa.scalar(0), pa.scalar(0)), tile)
        met += zip(found.column("a").to_pylist(), found.column("b").to_pylist())
    every = {(a, b) for b in range(80) for a in range(b) if set(held[a]) & set(held[b])}
    assert len(met) == len(every) and set(met) == every
