"""Memberships of the latest term and what is computed from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronomart.operators import membership, overlap
from chronomart.plans.store import TableStore
from chronomart.session import materialise, scratch_path
from workload import roles, titles
from workload.registry import query


def mart(spark, sf, group="l_suppkey"):
    return membership.membership_mart(
        roles.terms(spark, sf),
        roles.groups(spark, sf, group),
        roles.memberships(spark, sf, group),
        roles.members(spark, sf),
    )


_CTES = roles.membership_ctes()


@query("mart_membership", f"{_CTES} SELECT * FROM mart", text=["datacriacao"])
def mart_membership(spark, sf):
    return mart(spark, sf)


@query(
    "mart_diversity_top20",
    f"""{_CTES}, c AS (SELECT id_frente, nome_frente, partido, count(*) AS n FROM mart GROUP BY ALL),
        t AS (SELECT id_frente, nome_frente, count(*) AS total FROM mart GROUP BY ALL),
        h AS (SELECT id_frente, nome_frente, sum(pow(n / total, 2)) AS h
              FROM c JOIN t USING (id_frente, nome_frente) GROUP BY ALL)
        SELECT id_frente, nome_frente, round(h, 6) AS herfindahl_index, round(1 - h, 6) AS diversidade
        FROM h ORDER BY round(1 - h, 12) DESC, id_frente, nome_frente LIMIT 20""",
)
def mart_diversity_top20(spark, sf):
    top = membership.diversity_index(mart(spark, sf))
    return top.withColumns(
        {c: F.round(c, 6) for c in ("herfindahl_index", "diversidade")}
    )


@query(
    "mart_member_rank",
    f"""{_CTES} SELECT iddeputado, nome, partido, uf, count(DISTINCT id_frente) AS num_frentes
        FROM mart GROUP BY ALL""",
)
def mart_member_rank(spark, sf):
    return membership.member_ranking(mart(spark, sf))


@query(
    "mart_groups_per_term",
    f"""{_CTES} SELECT "idLegislatura", count(DISTINCT id) AS qtd_frentes FROM groups
        GROUP BY "idLegislatura" """,
)
def mart_groups_per_term(spark, sf):
    return membership.groups_per_term(roles.groups(spark, sf))


@query(
    "gra_overlap",
    f"""{_CTES} SELECT a.id_frente AS frente_1_id, a.nome_frente AS frente_1_nome,
               b.id_frente AS frente_2_id, b.nome_frente AS frente_2_nome, count(*) AS membros_comum
        FROM mart a JOIN mart b ON a.iddeputado = b.iddeputado AND a.id_frente < b.id_frente
        GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5
        ORDER BY membros_comum DESC, frente_1_id, frente_2_id LIMIT 50""",
)
def gra_overlap(spark, sf):
    return overlap.overlap_edges(materialise(mart(spark, sf), "mart"))


@query(
    "gra_overlap_all",
    f"""{_CTES} SELECT a.id_frente AS frente_1_id, a.nome_frente AS frente_1_nome,
               b.id_frente AS frente_2_id, b.nome_frente AS frente_2_nome, count(*) AS membros_comum
        FROM mart a JOIN mart b ON a.iddeputado = b.iddeputado AND a.id_frente < b.id_frente
        GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5""",
)
def gra_overlap_all(spark, sf):
    """Every edge of at least five common members."""
    return overlap.overlap_edges(materialise(mart(spark, sf), "mart"), k=None)


_TAGGED = f"""{roles.membership_ctes("l_partkey")},
    tagged AS (SELECT id, titulo, palavras, {titles.categories_sql("palavras")} AS categorias
               FROM (SELECT id, titulo, {titles.words_sql("titulo")} AS palavras FROM groups
                     WHERE "idLegislatura" = (SELECT max(id) FROM terms)))"""


def tagged_groups(spark, sf):
    latest = membership.latest_term(roles.groups(spark, sf, "l_partkey"), roles.terms(spark, sf))
    return titles.titles.with_categories(titles.titles.with_keywords(latest), titles.RULES)


@query(
    "mart_categories",
    f"""{_TAGGED} SELECT id, titulo, array_to_string(palavras, ' ') AS palavras_chave,
               array_to_string(categorias, ';') AS categorias FROM tagged""",
)
def mart_categories(spark, sf):
    """The tagged groups, saved and read back."""
    store = TableStore(spark, scratch_path(spark, "categories"))
    store.overwrite("gold_categorias", tagged_groups(spark, sf), as_of=roles.DAYS[-1])
    return store.read("gold_categorias").select(
        "id",
        "titulo",
        F.array_join("palavras_chave", " ").alias("palavras_chave"),
        F.array_join("categorias", ";").alias("categorias"),
    )


@query(
    "gra_member_specialisation",
    f"""{_TAGGED} SELECT iddeputado, nome, partido, categoria,
               count(DISTINCT id_frente) AS num_frentes_categoria
        FROM mart JOIN (SELECT id, unnest(categorias) AS categoria FROM tagged) t ON t.id = id_frente
        GROUP BY ALL HAVING count(DISTINCT id_frente) >= 2""",
)
def gra_member_specialisation(spark, sf):
    return membership.member_specialisation(mart(spark, sf, "l_partkey"), tagged_groups(spark, sf))
