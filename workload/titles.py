"""Keywords and categories of document texts and part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronomart.functions.text import LETTERS, STOPWORDS
from chronomart.operators import titles
from workload.registry import query, table

# Category rules over the words that part names are made of.
RULES = {
    "fixação": ["ring", "bolt", "rod", "gear"],
    "tamanho": ["small", "large"],
    "aparência": ["blue", "cold", "anvil"],
    "idade": ["new", "old"],
}


def words_sql(column: str) -> str:
    stops = ", ".join(f"'{w}'" for w in STOPWORDS)
    return f"""list_filter(string_split_regex(
        regexp_replace(lower({column}), '[^{LETTERS}\\s]', '', 'g'), '\\s+'),
        lambda w: length(w) > 3 AND w NOT IN ({stops}))"""


def categories_sql(words: str) -> str:
    hits = ", ".join(
        f"CASE WHEN list_has_any({words}, [{', '.join(repr(w) for w in vocabulary)}]) THEN '{name}' END"
        for name, vocabulary in RULES.items()
    )
    found = f"list_filter([{hits}], lambda c: c IS NOT NULL)"
    return f"""CASE WHEN len({words}) = 0 THEN ['Sem Categoria']
        WHEN len({found}) = 0 THEN ['Outros'] ELSE {found} END"""


TAGGED_PARTS = f"""SELECT id, titulo, palavras, {categories_sql("palavras")} AS categorias
    FROM (SELECT p_partkey AS id, p_name AS titulo, {words_sql("p_name")} AS palavras FROM part)"""


def documents(spark, sf):
    """Texts with their keywords. They are dealt out first: a task reads no less than a row group, and a file may have one only."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("titulo"))
    return titles.with_keywords(docs.repartition("id", "titulo"))


def tagged_parts(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("titulo")
    )
    return titles.with_categories(titles.with_keywords(parts), RULES)


@query(
    "txt_keywords",
    f"SELECT doc_id AS id, array_to_string({words_sql('text')}, ' ') AS palavras FROM documents",
)
def txt_keywords(spark, sf):
    return documents(spark, sf).select("id", F.array_join("palavras_chave", " ").alias("palavras"))


@query(
    "txt_term_frequency",
    f"""WITH k AS (SELECT doc_id, unnest({words_sql('text')}) AS tema FROM documents),
        f AS (SELECT tema, count(*) AS frequencia, CAST(ceil(count(DISTINCT doc_id) / 1000.0) AS BIGINT) AS partes
              FROM k GROUP BY tema)
        SELECT DISTINCT tema, frequencia, partes, doc_id AS exemplo FROM k JOIN f USING (tema)""",
)
def txt_term_frequency(spark, sf):
    """Terms of all documents with the ids of the documents that use them: texts are long, so the
    id stands for the title. The parts are taken apart again, as the place in them is by hash."""
    top = titles.top_terms(documents(spark, sf), example="id")
    return top.select("tema", "frequencia", "partes", F.explode("exemplos_frentes").alias("exemplo"))


@query(
    "txt_categories",
    f"SELECT id, titulo, array_to_string(categorias, ';') AS categorias FROM ({TAGGED_PARTS})",
)
def txt_categories(spark, sf):
    return tagged_parts(spark, sf).select(
        "id", "titulo", F.array_join("categorias", ";").alias("categorias")
    )


@query(
    "txt_category_distribution",
    f"""WITH k AS (SELECT titulo, unnest(categorias) AS categoria FROM ({TAGGED_PARTS})),
        n AS (SELECT categoria, count(*) AS num_frentes,
                     CAST(ceil(count(titulo) / 1000.0) AS BIGINT) AS partes FROM k GROUP BY categoria)
        SELECT categoria, num_frentes, partes, titulo AS exemplo FROM k JOIN n USING (categoria)""",
)
def txt_category_distribution(spark, sf):
    spread = titles.category_distribution(tagged_parts(spark, sf))
    return spread.select("categoria", "num_frentes", "partes", F.explode("exemplos").alias("exemplo"))
