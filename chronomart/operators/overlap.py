"""Groups that share members: the weighted edge list of the member-group graph."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.session import materialise


def weight_of_kth_edge(pairs: DataFrame, k: int) -> int:
    """A weight that at least ``k`` edges reach, from the edges between the largest groups alone.

    As many of the largest groups are taken as it needs for ``k`` edges (11 groups for 50). Each member
    lists its groups among them, never more than that many. 0 if there are too few edges to tell.
    """
    m = math.ceil((1 + math.sqrt(1 + 8 * k)) / 2)
    sizes = pairs.groupBy("_g").agg(F.count("*").alias("_n"))
    largest = sizes.orderBy(F.col("_n").desc(), "_g").limit(m).select("_g")
    listed = pairs.join(largest, "_g").groupBy("_m").agg(F.sort_array(F.collect_set("_g")).alias("_of"))
    first = listed.where(F.size("_of") > 1).select("_of", F.posexplode("_of").alias("_i", "_a"))
    second = first.select("_a", F.explode(F.slice("_of", F.col("_i") + 2, m)).alias("_b"))
    weights = second.groupBy("_a", "_b").agg(F.count("*").alias("_w"))
    kth = weights.orderBy(F.col("_w").desc()).limit(k).agg(F.count("*"), F.min("_w")).first()
    return kth[1] if kth[0] == k else 0


def busiest_members(pairs: DataFrame, most: int) -> DataFrame:
    """The ``most`` members of each group that are in most groups overall, by one order of all members.

    Spark limits each group before the shuffle as well as after it, so a large group sends few rows.
    """
    degrees = pairs.groupBy("_m").agg(F.count("*").alias("_d"))
    order = Window.partitionBy("_g").orderBy(F.col("_d").desc(), F.col("_m").desc())
    ranked = pairs.join(degrees, "_m").withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= most).select("_m", "_g")


def met_pairs(rows: DataFrame, block_rows: int = 2000) -> DataFrame:
    """``(_a, _b)``, once for each member that two groups share in ``rows``.

    Members in more than ``block_rows`` groups are paired in blocks of about that many, each pair of
    blocks under its own join key, so one member's pairs spread over many tasks.
    """
    crowded = (
        rows.groupBy("_m")
        .agg(F.count("*").alias("_d"))
        .where(F.col("_d") > block_rows)
        .select("_m", F.ceil(F.col("_d") / F.lit(block_rows)).cast("int").alias("_blocks"))
    )
    rows = (
        rows.join(crowded, "_m", "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        .withColumn("_block", F.pmod(F.xxhash64("_g"), F.col("_blocks")).cast("int"))
    )

    def side(n: int, i: Column, j: Column) -> DataFrame:
        return rows.select("_m", F.col("_g").alias(f"_g{n}"), i.alias("_i"), j.alias("_j"))

    # A row meets the rows of its own block and of every other block exactly once.
    block = F.col("_block")
    first = side(1, block, F.explode(F.sequence(block, F.col("_blocks") - 1)))
    second = side(2, F.explode(F.sequence(F.lit(0), block)), block)
    # Spark cannot tell how many rows an explode makes and might broadcast them.
    met = first.hint("merge").join(second.hint("merge"), ["_m", "_i", "_j"]).where(
        (F.col("_i") < F.col("_j")) | (F.col("_g1") < F.col("_g2"))
    )
    return met.select(F.least("_g1", "_g2").alias("_a"), F.greatest("_g1", "_g2").alias("_b"))


def common_counts(pairs: DataFrame, need: int, block_rows: int = 2000) -> DataFrame:
    """``(_a, _b, _w)``: pairs of groups with ``need`` members in common or more, of distinct rows ``(_m, _g)``.

    All members stand in one order, the busiest last. Of each group the ``need - 1`` last are set aside: two
    groups with ``need`` common members share one of the others (of the common ones, the first cannot be among
    the last ``need - 1`` of either). Only groups that meet there are candidates, so the members that
    are in very many groups pair nothing wherever others tell groups apart. A candidate's members set aside,
    ``need - 1`` at most on each side, are then counted exactly.
    """
    sizes = pairs.groupBy("_g").agg(F.count("*").alias("_size")).where(F.col("_size") >= need)
    pairs = pairs.join(sizes.select("_g"), "_g", "left_semi")
    if need <= 1:
        return met_pairs(pairs, block_rows).groupBy("_a", "_b").agg(F.count("*").alias("_w"))
    aside = materialise(busiest_members(pairs, need - 1), "aside")
    rest = pairs.join(aside, ["_m", "_g"], "left_anti").select("_m", "_g")
    met = materialise(met_pairs(rest, block_rows).groupBy("_a", "_b").agg(F.count("*").alias("_w")), "met")
    held = aside.groupBy("_g").agg(F.collect_list("_m").alias("_aside"))  # less than ``need`` each
    known = met.join(held.toDF("_a", "_aside_a"), "_a").join(held.toDF("_b", "_aside_b"), "_b")
    both = F.size(F.array_intersect("_aside_a", "_aside_b"))
    known = materialise(known.select("_a", "_b", (F.col("_w") + both).alias("_w"), "_aside_a", "_aside_b"), "known")

    def across(side: str, other: str) -> DataFrame:
        """Members set aside on one side that the other has among its rest."""
        alone = F.array_except(f"_aside{other}", f"_aside{side}")
        asked = known.select("_a", "_b", F.col(side).alias("_g"), F.explode(alone).alias("_m"))
        return asked.join(rest, ["_m", "_g"], "left_semi").select("_a", "_b", F.lit(1).cast("long").alias("_w"))

    parts = known.select("_a", "_b", "_w").unionByName(across("_a", "_b")).unionByName(across("_b", "_a"))
    return parts.groupBy("_a", "_b").agg(F.sum("_w").alias("_w")).where(F.col("_w") >= need)


def overlap_edges(
    mart: DataFrame,
    member: str = "iddeputado",
    group: str = "id_frente",
    group_name: str = "nome_frente",
    min_common: int = 5,
    k: int | None = 50,
    block_rows: int = 2000,
) -> DataFrame:
    """Pairs of groups with at least ``min_common`` members in common, the strongest first; all of them without ``k``.

    For the ``k`` strongest edges the least weight of interest rises from ``min_common`` to what the
    ``k``-th edge between the largest groups weighs already. See :func:`common_counts` for how pairs are found. The
    distinct (member, group) rows are written once to the shared folder, since degrees, group sizes and
    the pairing read them. Names are looked up after the pairs were counted and cut to ``k``.
    """
    pairs = materialise(
        mart.where(F.col(member).isNotNull() & F.col(group).isNotNull())
        .select(F.col(member).alias("_m"), F.col(group).alias("_g"))
        .distinct(),
        "pairs",
    )
    need = min_common if k is None else max(min_common, weight_of_kth_edge(pairs, k))
    edges = common_counts(pairs, need, block_rows).toDF("frente_1_id", "frente_2_id", "membros_comum")
    strongest = [F.col("membros_comum").desc(), "frente_1_id", "frente_2_id"]
    if k is not None:
        edges = edges.orderBy(*strongest).limit(k)

    named = edges.select(F.explode(F.array("frente_1_id", "frente_2_id")).alias("_id")).distinct()
    names = (
        mart.select(F.col(group).alias("_id"), F.col(group_name).alias("_name"))
        .join(named, "_id", "left_semi")
        .groupBy("_id")
        .agg(F.min("_name").alias("_name"))
    )
    return (
        edges.join(names.toDF("frente_1_id", "frente_1_nome"), "frente_1_id", "left")
        .join(names.toDF("frente_2_id", "frente_2_nome"), "frente_2_id", "left")
        .select("frente_1_id", "frente_1_nome", "frente_2_id", "frente_2_nome", "membros_comum")
        .orderBy(*strongest)
    )
