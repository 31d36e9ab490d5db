import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chronomart.llm import lexical_search
from chronomart.llm.queries import QUERIES, SQL
from tests.compare import connect, difference
from tests.llm.fixtures import documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if i is not None and terms(t)]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc, c in counted:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in wanted if t in c}
            scores.append((-sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items()), doc))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(best, 1)]
    return sorted(out)


def tables(seed=5):
    rng = random.Random(seed)
    rows = documents()
    rows += [(9_000 + i, t, None, None, None) for i, t in enumerate(
        ["ÀB àb ab", "x\u0085y x y", "W1 w1\x00w2", "naïve NAÏVE 北京 ２", "!!! ---", "w1 " * 3000, "w5 w6", "w5 w6", "w5 w6"])]
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.choices(rng.choice(texts).split(" "), k=3) + rng.choice(texts).split()[:20])) for i in range(30)]
    items += [(40, None), (41, ""), (42, "unknownterm"), (43, "W1 w1 w1"), (44, "àb ÀB 北京 naïve"), (None, "w1"), (45, "w5"), (45, "w6"),
              (46, texts[0]), (46, texts[0]), (47, " ".join(texts)[:40_000])]
    return rows, items


@pytest.fixture()
def folder(spark, tmp_path):
    rows, items = tables()
    frame(spark, rows).withColumnRenamed("source", "score").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    return str(tmp_path)


def found(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_query_against_brute_force(spark, folder):
    rows, items = tables()
    assert found(QUERIES["op11_lexical_search"](spark, folder)) == brute([r[:2] for r in rows], items)


def test_query_against_sql(spark, folder):
    name = "op11_lexical_search"
    assert difference(spark, connect(folder), name, QUERIES[name], SQL[name], folder) is None


def test_small_tiles_and_blocks_give_the_same(spark, monkeypatch):
    rows, items = tables(6)
    monkeypatch.setattr(lexical_search, "TILE_ITEMS", 4)
    monkeypatch.setattr(lexical_search, "TILE_TERMS", 40)
    monkeypatch.setattr(lexical_search, "TILE_VALUES", 400)
    monkeypatch.setattr(lexical_search, "PIECE", 50)
    items_df = spark.createDataFrame(items, "item_id long, text string")
    ranked = lexical_search.search(frame(spark, rows), items_df, k=3, block_terms=150)
    assert found(ranked) == brute([r[:2] for r in rows], items, 3)


def test_sums_stay_exact(monkeypatch):
    """Column tiles are cut before a sum could reach the bound, and nothing is lost at the cuts."""
    monkeypatch.setattr(lexical_search, "EXACT", 3.0 * lexical_search.IMPACTS * 1000)
    rng = np.random.default_rng(1)
    items, terms = np.repeat(np.arange(5), 50), np.tile(np.arange(50), 5)
    weights = rng.integers(1, 1000, 250)
    (tile,) = lexical_search.item_tiles(items, terms, weights)
    assert len(tile.cuts) > 10 and tile.cuts[0] == 0 and tile.cuts[-1] == 50
    whole = tile.weights()
    assert all(whole[:, a:b].sum(axis=1).max() * lexical_search.IMPACTS < lexical_search.EXACT for a, b in zip(tile.cuts, tile.cuts[1:]))


def test_ties_at_the_edge_of_a_tile():
    best = lexical_search.Best(1, 3)
    best.add(np.array([[5, 5, 5, 5, 2]]), np.array([9, 8, 7, 6, 1]))
    best.add(np.array([[5, 5, 0, 1]]), np.array([2, 30, 0, 3]))
    assert best.docs.tolist() == [2, 6, 7] and best.scores.tolist() == [5, 5, 5]


def test_empty_tables(spark):
    rows, items = tables()
    docs, asked = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(docs.limit(0), asked).count() == 0
    assert lexical_search.search(docs, asked.limit(0)).count() == 0
