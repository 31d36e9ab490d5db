import hashlib
import random

import pytest

from chronomart.llm import substring_dedup
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import documents, frame, words

WINDOW = 20


def brute(rows):
    """(doc_id, n_words, n_removed, kept) per row, windows compared word by word."""
    rows = [(k, words(t)) for k, t in rows]
    first = {}
    for key, ws in sorted({(k, tuple(w)) for k, w in rows if k is not None}):
        for at in range(len(ws) - WINDOW + 1):
            first.setdefault(tuple(ws[at : at + WINDOW]), (key, at))
    out = []
    for key, ws in rows:
        gone = [False] * len(ws)
        for at in range(len(ws) - WINDOW + 1) if key is not None else ():
            if first[tuple(ws[at : at + WINDOW])] < (key, at):
                gone[at : at + WINDOW] = [True] * WINDOW
        kept = [w for w, g in zip(ws, gone) if not g]
        out.append((key, len(ws), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in QUERIES["op3_substring_dedup"](spark, str(tmp_path)).collect()), key=str)


def test_awkward_documents(spark, tmp_path):
    rows = documents()
    assert found(spark, rows, tmp_path) == brute([r[:2] for r in rows])


@pytest.mark.parametrize("seed", [1, 2])
def test_few_words_many_repeats(spark, tmp_path, seed):
    rng = random.Random(seed)
    parts = [[rng.choice("ab") for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(60):
        ws = [w for _ in range(rng.randint(0, 6)) for w in rng.choice(parts)]
        rows.append((rng.randrange(10**6) * 60 + i, " ".join(ws), None, None, None))
    assert found(spark, rows, tmp_path) == brute([r[:2] for r in rows])


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op3_substring_dedup"](spark, sf).collect()), key=str) == brute(rows)


def test_no_rows_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, found int, doc int")
    assert substring_dedup.remove_repeats(empty).count() == 0
    one = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, kept int, doc int")
    assert [tuple(r) for r in substring_dedup.remove_repeats(one).collect()] == [(1, 2, 0, "a b")]


def test_a_document_that_is_gone_still_comes_first(spark, tmp_path):
    """Windows across the end of one copy and the begin of the next are first seen in a text that loses all its words."""
    rng, rows = random.Random(6), []

    def text(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    for i in range(400):
        source = text(200)
        for k, ws in enumerate((source[:100], source[90:], source, text(30) + source[85:110] + text(30))):
            rows.append((4 * i + k, " ".join(ws), None, None, None))
    assert found(spark, rows, tmp_path) == brute([r[:2] for r in rows])
