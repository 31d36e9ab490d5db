import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronomart.llm import packing
from chronomart.llm.queries import QUERIES
from chronomart.llm.word_bpe import word_bpe
from tests.llm.fixtures import documents, frame

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abeirTHNS'tsé ß12,.!\n", max_size=80), st.text("ΣσǺİ€–’日 <|endoftext>", max_size=30)))
def test_same_ids_as_the_library(text):
    assert word_bpe(PATH).ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_plain_character_alone_and_in_words():
    chars = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    for text in chars + [f"a{c}b {c}{c} x{c}" for c in chars]:
        assert word_bpe(PATH).ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids, ascii(text)


def check(rows, found, capacity=4096):
    """Whole: every piece of every row once, and sequences without gaps or overflow."""
    expected = []
    for key, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            expected.append((key, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(expected, key=str) == sorted((tuple(r)[:5] for r in found), key=str)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return sum(e[3] for e in expected), len(sequences)


def test_awkward_documents(spark, tmp_path):
    rows = documents()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    check([r[:2] for r in rows], QUERIES["op9_best_fit_packing"](spark, str(tmp_path)).collect())


def test_given_documents_fill_their_sequences(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    total, sequences = check(rows, QUERIES["op9_best_fit_packing"](spark, sf).collect())
    assert sequences <= 1.01 * total / 4096 + 1


def test_rounds_over_many_tasks(spark):
    rows = [(i, "a " * (i * 37 % 90)) for i in range(400)] + [(1000 + i, "b " * 59) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = packing.pack(docs, PATH, capacity=100, slack=1, per_task=60).collect()
    _, sequences = check(rows, found, 100)
    sizes = np.array([len(text) // 2 + 1 for _, text in rows])
    assert sequences <= 1.03 * (packing.best_fit(sizes, 100).max() + 1)


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, size int"), PATH).count() == 0


@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_never_overflows_and_leaves_one_bin_half_empty(sizes):
    bins = packing.best_fit(np.array(sizes, np.int64), 50)
    filled = np.bincount(bins, weights=sizes).tolist() if sizes else []
    assert all(0 < f <= 50 for f in filled) and sum(f <= 25 for f in filled) <= 1
