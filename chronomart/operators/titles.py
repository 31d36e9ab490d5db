"""Keywords, term frequencies and categories of titled rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.text import CATEGORIES, LETTERS, STOPWORDS, categories, keywords
from chronomart.operators.aggregates import collect_in_parts


def with_keywords(
    df: DataFrame,
    title: str = "titulo",
    stopwords: Sequence[str] = STOPWORDS,
    letters: str = LETTERS,
) -> DataFrame:
    return df.withColumn("palavras_chave", keywords(title, stopwords, letters))


def with_categories(
    df: DataFrame, rules: Mapping[str, Sequence[str]] = CATEGORIES, words: str = "palavras_chave"
) -> DataFrame:
    return df.withColumn("categorias", categories(words, rules))


def _one_per_row(df: DataFrame, items: Column, name: str, *columns: Column) -> DataFrame:
    """Explode an array of non-null items. For a plain explode Spark first filters on the array's
    size, which would compute the keywords a second time; the outer form has no such filter."""
    return df.select(F.explode_outer(items).alias(name), *columns).where(F.col(name).isNotNull())


def term_frequency(tagged: DataFrame, words: str = "palavras_chave") -> DataFrame:
    """Occurrences of each keyword over all titles. Counts combine before the shuffle."""
    return (
        _one_per_row(tagged, F.col(words), "tema")
        .groupBy("tema")
        .agg(F.count("*").alias("frequencia"))
    )


def top_terms(
    tagged: DataFrame, example: str = "titulo", words: str = "palavras_chave", max_items: int = 1000
) -> DataFrame:
    """Keyword, frequency and the distinct titles (or, for long texts, ids) it appears in, the
    most frequent first. Titles come in parts as :func:`collect_in_parts` makes them. One pass over
    the texts gives both: occurrences per keyword and title."""
    pairs = _one_per_row(tagged, F.col(words), "tema", F.col(example).alias("_example"))
    return (
        collect_in_parts(
            pairs,
            ["tema"],
            "_example",
            "exemplos_frentes",
            distinct=True,
            max_items=max_items,
            count_name="frequencia",
        )
        .select("tema", "frequencia", "parte", "partes", "exemplos_frentes")
        .orderBy(F.col("frequencia").desc(), "tema", "parte")
    )


def category_distribution(tagged: DataFrame, example: str = "titulo", max_items: int = 1000) -> DataFrame:
    """Rows and titles per category, the largest first. Titles repeat as often as they occur."""
    rows = _one_per_row(tagged, F.col("categorias"), "categoria", F.col(example).alias("_example"))
    return (
        collect_in_parts(
            rows,
            ["categoria"],
            "_example",
            "exemplos",
            distinct=False,
            max_items=max_items,
            count_name="num_frentes",
        )
        .select("categoria", "num_frentes", "parte", "partes", "exemplos")
        .orderBy(F.col("num_frentes").desc(), "categoria", "parte")
    )
