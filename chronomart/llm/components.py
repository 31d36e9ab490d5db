"""Connected components as joins: every node points to ever smaller ones until all point to the least."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.scratch import written


def _turned(node: str, other: str) -> list:
    return [F.col(node).alias("node"), F.col(other).alias("other")]


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each node and its others. Written, so that the join that follows has plain exchanges on
    both sides and can split a node with very many others over tasks."""
    return written(
        pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least")), "least"
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node that occurs in ``edges``; component is the least node reached.

    Alternates two steps: a node's larger neighbours are linked to its least one, then its smaller
    neighbours and the node itself are. Neither breaks a connection; once a round changes nothing every
    component is a star. Edges with a null end and loops are left out, repeated ones count once.
    Nodes are numbers or strings. Runs jobs and writes to the shared folder.
    """
    pairs = written(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(*_turned("other", "node")))
        larger = written(
            both.where("other > node")
            .join(_least(both), "node")
            .select(*_turned("other", "least"))
            .where("node <> other")
            .distinct(),
            "larger",
        )
        least = _least(larger)
        smaller = larger.join(least, "node").select(*_turned("other", "least"))
        pairs = written(
            smaller.unionByName(least.select(*_turned("node", "least"))).where("node <> other").distinct(),
            "smaller",
        )
        # Equal sets of pairs have equal counts and sums of hashes.
        after = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).first()
        if after == before:
            stars = pairs.select("node", F.col("other").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
