import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chronomart.llm import byte_bpe
from chronomart.llm.queries import QUERIES

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TRANSDUCER = byte_bpe.Transducer(byte_bpe.Ranks(PATH), max_states=5000)
DECODER = byte_bpe.StreamDecoder(TRANSDUCER.ranks)


ENCODER = byte_bpe.Encoder(PATH, P.PATTERN, spaced=True, max_parts=50)


def own(text):
    ids = ENCODER.ids(text)
    assert ids == byte_bpe.Encoder(PATH, P.PATTERN, spaced=False).ids(text)
    return ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text("abertinghsolu ", max_size=80), st.text("éüßñ日本語 aÀ", max_size=40), st.text("a1.' \n\x85\x1c", max_size=12)))
def test_same_ids_as_the_library(library, text):
    ids = own(text)
    assert ids == library.encode_ordinary(text)
    assert b"".join(DECODER.stream(ids)) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text("日本語é😀a", max_size=20))
def test_stream_gives_whole_characters(library, text):
    for part in DECODER.stream(own(text)):
        part.decode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=12))
def test_incomplete_tail_agrees_with_the_codec(data):
    import codecs

    text = "é日😀a".encode()[: len(data)]
    decoder = codecs.getincrementaldecoder("utf-8")()
    decoder.decode(text)
    assert byte_bpe.incomplete(text) == len(decoder.getstate()[0])


def test_tokens_come_before_the_end():
    seen = []

    def spy(data):
        for n, byte in enumerate(data):
            yield byte
            seen.append(n)

    stream = TRANSDUCER.stream(spy(b"the quick brown foxes and many other animals" * 3))
    next(stream)
    assert len(seen) < 40


def test_edge_rows(spark, library, tmp_path):
    long = "word " * 50_000 + "x" * 20_000
    rows = [(1, None, "a"), (2, "", "b"), (3, "a b", "c"), (3, "a b", "c"), (None, "née", "d"), (4, long, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {tuple(r) for r in QUERIES["op2_byte_bpe"](spark, str(tmp_path)).collect()}
    expected = set()
    for doc_id, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        expected.add((doc_id, len(ids), hashlib.sha256(joined).hexdigest(),
                      hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == expected
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(empty, PATH, P.PATTERN), PATH).count() == 0


def test_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op2_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_texts_of_a_batch(library):
    """Parts are numbered and gathered over a batch; words that come with a mark or a line break first are known by themselves later."""
    texts = ["one two, three.\nFour five", None, "", " ", "two three Four\nfive,\nsix.\n7", "one.\ńx a.\n.b c.\n", "two,\nthree, a b."]
    encoder = byte_bpe.Encoder(PATH, P.PATTERN, spaced=True, max_parts=5)
    for _ in range(3):
        assert [ids.tolist() for ids in encoder.batch(texts)] == [library.encode_ordinary(t or "") for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab.,\n é1'", max_size=25), max_size=5))
def test_batches_of_odd_texts(library, texts):
    assert [ids.tolist() for ids in ENCODER.batch(texts)] == [library.encode_ordinary(t) for t in texts]
    for text in texts:
        assert DECODER.whole(library.encode_ordinary(text)) == text.encode()
