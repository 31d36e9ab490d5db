"""Keywords and categories against plain Python, and parsing of dirty text."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronomart.functions import arrays, hashing, parsing, text
from chronomart.operators import aggregates, titles

quick = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

TITLES = [
    None, "", "   ", "Frente-X Saúde 2ª", "Saúde Pública", "SUS", "Frente Parlamentar Mista",
    "Educação e Cultura: inclusão!", "a\tb\nENSINO  superior", "grün Österreich", "ÀS ESCOLAS rurais",
    "linha\x1cseparada larga　ampla", "1234 56", "meio ambiente digital",
]


def plain_keywords(title):
    kept = re.sub(rf"[^{text.LETTERS}\s]", "", (title or "").lower())
    return [w for w in kept.split() if len(w) > 3 and w not in text.STOPWORDS]


def plain_categories(words):
    if not words:
        return [text.NO_KEYWORDS]
    return [n for n, v in text.CATEGORIES.items() if set(v) & set(words)] or [text.NO_MATCH]


def check(spark, values):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "id int, titulo string")
    tagged = titles.with_categories(titles.with_keywords(df))
    for r in tagged.collect():
        assert r.palavras_chave == plain_keywords(r.titulo), repr(r.titulo)
        assert r.categorias == plain_categories(r.palavras_chave), repr(r.titulo)


def test_known_titles(spark):
    check(spark, TITLES)


@quick
@given(
    st.lists(
        st.lists(
            st.sampled_from(["saúde", "Escola", "DE", "frente", " ", " ", "-", "clima", "x", "ção", "9"])
        ).map("".join),
        min_size=1,
        max_size=20,
    )
)
def test_generated_titles(spark, values):
    check(spark, values)


def test_fixed_values():
    assert len(text.STOPWORDS) == 31 and len(text.CATEGORIES) == 10
    assert text.unreachable_rules() == {"Saúde": ["sus"]}


def parts_of(df, key):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


def test_hot_key_is_split_and_stays_whole(spark):
    """One key with a third of all rows, many small ones."""
    df = spark.range(6000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
        (F.col("id") % 1500).cast("string").alias("v"),
    )
    for distinct in (True, False):
        found = aggregates.collect_in_parts(df, ["k"], "v", "vs", distinct, max_items=100)
        parts = parts_of(found, "k")
        assert len(parts["hot"]) > 10 and len(parts["k7"]) == 1
        hot = sorted(v for r in parts["hot"] for v in r.vs)
        expected = [str(i % 1500) for i in range(2000)]
        assert hot == sorted(set(expected) if distinct else expected)
        assert max(len(r.vs) for r in parts["hot"]) < 200
        assert parts["hot"][0].quantidade == 2000


def test_repeated_values_hold_the_bound_too(spark):
    """One value 15,000 times among others, and few values in very many rows."""
    df = spark.range(15_300).select(
        F.lit("k").alias("k"), F.when(F.col("id") < 15_000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v")
    )
    lists = aggregates.collect_in_parts(df, ["k"], "v", "vs", False).collect()
    assert len(lists) == 16 and {r.partes for r in lists} == {16}
    assert max(len(r.vs) for r in lists) <= 1100 and sum(len(r.vs) for r in lists) == 15_300
    few = spark.range(50_000).select(F.lit("k").alias("k"), (F.col("id") % 30).alias("v"))
    found = aggregates.collect_in_parts(few, ["k"], "v", "vs", True).collect()
    assert [(r.quantidade, r.partes, r.vs) for r in found] == [(50_000, 1, list(range(30)))]


def test_null_key_keeps_its_values(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("k", "c")], "k string, v string")
    found = aggregates.collect_in_parts(df, ["k"], "v", "vs", True)
    assert {r.k: r.vs for r in found.collect()} == {None: ["a", "b"], "k": ["c"]}


def test_terms_and_categories_with_examples(spark):
    df = spark.createDataFrame(
        [(1, "Saúde saúde rural"), (2, "Saúde digital"), (3, "Saúde digital"), (4, "nada"), (5, None)],
        "id int, titulo string",
    )
    tagged = titles.with_categories(titles.with_keywords(df))
    terms = {r.tema: (r.frequencia, r.exemplos_frentes) for r in titles.top_terms(tagged).collect()}
    assert terms["saúde"] == (4, ["Saúde digital", "Saúde saúde rural"])
    assert terms["digital"] == (2, ["Saúde digital"])
    spread = {r.categoria: (r.num_frentes, r.exemplos) for r in titles.category_distribution(tagged).collect()}
    assert spread["Saúde"] == (3, ["Saúde digital", "Saúde digital", "Saúde saúde rural"])
    assert spread[text.NO_KEYWORDS] == (1, []) and spread[text.NO_MATCH] == (1, ["nada"])


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr.alias("x")).first().x


def test_timestamps(spark):
    cases = ["2020-01-01T10:00", "2020-01-01T10:00:05", "", "junk", None]
    df = spark.createDataFrame([(c,) for c in cases], "v string").select(
        parsing.parse_timestamp("v").isNotNull().alias("with_pattern"),
        parsing.parse_timestamp("v", None).isNotNull().alias("default"),
    )
    assert [r.with_pattern for r in df.collect()] == [False, True, False, False, False]
    assert [r.default for r in df.collect()] == [True, True, False, False, False]


def test_integers(spark):
    cases = ["12", " 7 ", "-3", "+4", "1.0", "", "x", "99999999999", None]
    df = spark.createDataFrame([(c,) for c in cases], "v string").select(parsing.to_int("v").alias("x"))
    assert [r.x for r in df.collect()] == [12, 7, -3, 4, None, None, None, None, None]
    assert one(spark, 5, parsing.to_int("v"), "bigint") == 5


def test_uri_id(spark):
    get = parsing.uri_id("v", "proposicoes")
    assert one(spark, "http://x/proposicoes/123/temas", get) == "123"
    assert one(spark, "http://x/other/1", get) == ""
    assert one(spark, None, get) is None


def test_id_lists(spark):
    ids = arrays.join_ids(arrays.field_as_int("v"))
    dtype = "array<struct<id:string>>"
    assert one(spark, [("1",), (None,), ("x",), ("3",)], ids, dtype) == "1,3"
    assert one(spark, [], ids, dtype) == ""
    assert one(spark, None, ids, dtype) is None
    assert one(spark, "", arrays.split_ids("v")) == []
    assert one(spark, "1,3", arrays.split_ids("v")) == ["1", "3"]


def test_stable_key_is_positive_and_fixed(spark):
    assert one(spark, "Reunião", hashing.stable_key("v")) == one(spark, "Reunião", hashing.stable_key("v"))
    assert one(spark, "a", hashing.stable_key("v")) == int("0cc175b9c0f1b6a", 16)
