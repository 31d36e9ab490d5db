"""The membership mart and what is computed from it: diversity, rankings, overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.operators.rows import current_rows, latest_by


def latest_term(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """Current groups of the term that started last."""
    return current_rows(groups).where(
        F.col("idLegislatura") == latest_by(current_rows(terms), "id", "dataInicio")
    )


def membership_mart(
    terms: DataFrame, groups: DataFrame, memberships: DataFrame, members: DataFrame
) -> DataFrame:
    """One row per membership in a group of the latest term. Tables with history take part with
    their current rows only, so closed versions do not multiply members."""
    g = latest_term(groups, terms).alias("g")
    s = current_rows(memberships).alias("s")
    m = current_rows(members).alias("m")
    return (
        g.join(s, F.col("g.id") == F.col("s.id"))
        .join(m, F.col("s.iddeputado") == F.col("m.id"))
        .select(
            F.col("g.id").alias("id_frente"),
            F.col("g.titulo").alias("nome_frente"),
            F.col("g.datacriacao").alias("datacriacao"),
            F.col("g.idLegislatura").alias("idLegislatura"),
            F.col("s.iddeputado").alias("iddeputado"),
            F.col("s.nome").alias("nome"),
            F.col("m.siglaPartido").alias("partido"),
            F.col("s.siglaUf").alias("uf"),
        )
    )


def diversity_index(
    mart: DataFrame,
    group: Sequence[str] = ("id_frente", "nome_frente"),
    label: str = "partido",
    k: int | None = 20,
) -> DataFrame:
    """Herfindahl index of each group's labels and its complement, the most diverse first.

    The index is the sum of squared label counts over the squared total, from one aggregate of
    the label counts: no join with totals, and equal distributions give equal values. Groups
    with a null key part are left out.
    """
    sizes = (
        mart.where(" AND ".join(f"`{c}` IS NOT NULL" for c in group))
        .groupBy(*group, label)
        .agg(F.count("*").cast("double").alias("_n"))
    )
    index = sizes.groupBy(*group).agg(
        (F.sum(F.col("_n") * F.col("_n")) / (F.sum("_n") * F.sum("_n"))).alias("herfindahl_index")
    ).withColumn("diversidade", 1 - F.col("herfindahl_index"))
    if k is None:
        return index
    # Rounding in the order keeps ties ties; the key decides between them.
    return index.orderBy(F.round("diversidade", 12).desc(), *group).limit(k)


def member_ranking(
    mart: DataFrame, member: Sequence[str] = ("iddeputado", "nome", "partido", "uf")
) -> DataFrame:
    """Distinct groups per member, the busiest first."""
    return (
        mart.groupBy(*member)
        .agg(F.count_distinct("id_frente").alias("num_frentes"))
        .orderBy(F.col("num_frentes").desc(), *member)
    )


def groups_per_term(groups: DataFrame) -> DataFrame:
    """Distinct groups per term, the latest term first."""
    return (
        current_rows(groups)
        .groupBy("idLegislatura")
        .agg(F.count_distinct("id").alias("qtd_frentes"))
        .orderBy(F.col("idLegislatura").desc())
    )


def member_specialisation(mart: DataFrame, tagged: DataFrame, min_groups: int = 2) -> DataFrame:
    """Members found in at least ``min_groups`` groups of one category."""
    tags = tagged.select(F.col("id").alias("id_frente"), "categorias")
    return (
        mart.join(tags, "id_frente")
        .select(
            "iddeputado", "nome", "partido", "id_frente", F.explode("categorias").alias("categoria")
        )
        .groupBy("iddeputado", "nome", "partido", "categoria")
        .agg(F.count_distinct("id_frente").alias("num_frentes_categoria"))
        .where(F.col("num_frentes_categoria") >= min_groups)
        .orderBy(
            F.col("num_frentes_categoria").desc(), "iddeputado", "categoria", "nome", "partido"
        )
    )
