import math
import random

from pyspark.sql import functions as F

from chronomart.llm import topk_search
from chronomart.llm.queries import QUERIES


def brute(rows, k=10):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {(i, tuple(v)) for i, v in usable if i % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_awkward_vectors(spark, tmp_path):
    rng = random.Random(4)
    same = [0.25, -0.5, 0.125, 1.0, 0.0]
    rows = [(i, [rng.choice([-1, 1]) * rng.random() for _ in range(5)]) for i in range(0, 700, 7)]
    rows += [(i, same) for i in range(1, 400, 6)] + [(800, same), (800, same), (900, None), (901, [None, 1.0]),
             (902, [math.nan] * 5), (903, [math.inf] * 5), (None, same), (1000, []), (905, [0.5]), (1100, [1e6] * 5)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert rows_of(QUERIES["op6_topk_search"](spark, str(tmp_path))) == brute(
        [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    )


def test_several_batches_of_queries(spark, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(topk_search, "BLOCK", 16)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(0, 1200, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.top_k(df, F.col("vec_id") % 100 == 0, k=3, batch_values=30)
    assert rows_of(found) == brute(rows, 3)


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    assert rows_of(topk_search.top_k(df, F.col("vec_id") == 0)) == [(0, 1, 3, 1024 * 2048)]
    assert topk_search.top_k(df, F.col("vec_id") == 77).count() == 0
    assert topk_search.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
