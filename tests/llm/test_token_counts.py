import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronomart.llm import token_counts
from chronomart.llm.queries import QUERIES
from tests.llm.fixtures import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_query_counts_whole_texts_as_the_library(spark, tmp_path):
    rng = random.Random(8)
    rows = documents()
    awkward = ["<|endoftext|>", "a<|endoftext|> b  <|endoftext|>  c", "<|endoftext", "I'll we've  \n\n it's 's", "a b c\u0085d",
               "aaaa" * 3000, "".join(rng.choice("abcdehlnorst") for _ in range(30_000)), "१२३ ٤٥ ½ Ⅷ 北京大学", "é" * 5000,
               "\x1c \x1d\x1e\x1f ​﻿ x", "😀👩‍👩‍👧 🇩🇪", "x" * 2048 + " " + "y" * 2049, "=" * 9000, " " * 5000 + "z"]
    rows += [(8_000 + i, t, None, None, None) for i, t in enumerate(awkward)]
    frame(spark, rows).withColumnRenamed("n_chars", "n_tokens").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_token_counts"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    counts = expected([r[1] for r in rows])
    want = [(r[0], len((r[1] or "").encode()), n, n > 512) for r, n in zip(rows, counts)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert token_counts.token_counts(frame(spark, []), PATH, 512).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert token_counts.counter(PATH).counts([text]) == expected([text])


def test_pre_tokens_of_every_character():
    """The library's and our expression put each character in the same class, alone and between letters."""
    texts = [f"a{chr(c)}{chr(c)} {chr(c)}b" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert token_counts.counter(PATH).counts(texts) == expected(texts)


@pytest.mark.parametrize("size", [10, 300, 40_000])
def test_long_words_are_merged_as_short_ones(size):
    rng = random.Random(size)
    merges = token_counts.counter(PATH).merges
    for letters in ("ab", "aeinrst", "=-"):
        word = "".join(rng.choice(letters) for _ in range(size))
        assert merges._long(merges.symbols[np.frombuffer(word.encode(), np.uint8)]) == expected([word])[0]


def test_merge_lists_that_do_not_rise(tmp_path):
    """A merge that comes before one that makes its half is applied leftmost first."""
    import json

    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["merges"] = [["ab", "a"], ["a", "b"], ["b", "a"]]
    spec["model"]["vocab"] |= {"aba": 90_001, "ab": 90_002, "ba": 90_003}
    path = tmp_path / "own.json"
    path.write_text(json.dumps(spec))
    library = Tokenizer.from_file(str(path))
    counter = token_counts.Counter(str(path))
    assert not counter.merges.rising
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(200)]
    assert counter.counts(words) == [len(library.encode(w, add_special_tokens=False).ids) for w in words]


def test_memory_of_counts_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN", 50)
    monkeypatch.setattr(token_counts, "RUN", 40)
    monkeypatch.setattr(token_counts, "WHOLE", 100)
    counter = token_counts.Counter(PATH)
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 300))) for _ in range(30)]
    assert counter.counts(texts) == expected(texts)
    assert len(counter.known) <= 50 + 40
