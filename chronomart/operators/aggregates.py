"""Aggregates with a shape of their own: shares of a parent total, and value lists in parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, parent: Sequence[str], label: Sequence[str]) -> DataFrame:
    """Rows per (parent, label), rows per parent, and their ratio.

    The totals are summed from the per-label counts, so the rows themselves are shuffled once,
    after partial counting.
    """
    counts = df.groupBy(*parent, *label).agg(F.count("*").alias("quantidade"))
    totals = counts.groupBy(*parent).agg(F.sum("quantidade").alias("total"))
    return counts.join(totals, list(parent)).withColumn(
        "proporcao", F.col("quantidade") / F.col("total")
    )


def collect_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    distinct: bool,
    max_items: int = 1000,
    count_name: str = "quantidade",
) -> DataFrame:
    """All values of each key as sorted arrays, one row per key and part, with the key's row count.

    The grain is (key, part) for every key; ``partes`` is what the key's values, the different ones
    with ``distinct``, need at ``max_items`` each. Different values are spread over the parts by hash,
    so an array is about that long and never a multiple of it; equal values of a list are dealt out to
    all parts evenly. Null is no value but counts as a row: a key without values gives one empty array.

    Rows are counted per key and value first, combined before the shuffle, so a value repeated any
    number of times travels as one row, and no array, group or task holds a whole hot key.
    """
    held = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    items = F.count(value) if distinct else F.sum(F.when(F.col(value).isNotNull(), F.col("_n")))
    sizes = held.groupBy(*keys).agg(
        F.sum("_n").alias(count_name),
        F.greatest(F.lit(1), F.ceil(F.coalesce(items, F.lit(0)) / F.lit(max_items))).cast("bigint").alias("partes"),
    )
    same_key = reduce(and_, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    # A left join can build a hash table of the sizes only, never of the values.
    sized = held.alias("r").join(sizes.alias("s"), same_key, "left").select("r.*", f"s.{count_name}", "s.partes")
    start = F.coalesce(F.xxhash64(value), F.lit(0))
    if distinct:
        # Read from the count: with the same columns on both sides of the join, the rows are computed and shuffled once.
        once = F.least("_n", F.lit(1)).cast("int")
        placed = sized.withColumn("parte", F.pmod(start, F.col("partes"))).withColumn("_copies", once)
    else:
        turns = F.sequence(F.lit(0).cast("bigint"), F.least("_n", "partes") - 1)
        each = F.floor(F.col("_n") / F.col("partes")) + (F.col("_turn") < F.col("_n") % F.col("partes")).cast("int")
        placed = (
            sized.withColumn("_turn", F.explode(turns))
            .withColumn("parte", F.pmod(F.pmod(start, F.col("partes")) + F.col("_turn"), F.col("partes")))
            .withColumn("_copies", each.cast("int"))
        )
    copies = F.when(F.col(value).isNull(), F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")).otherwise(
        F.array_repeat(value, F.col("_copies"))
    )
    # Grouping by (keys, parte) would accept the join's partitioning by keys and with it the hot
    # key's task. An explicit exchange spreads the parts and lets the skewed join be split.
    return (
        placed.repartition(*keys, "parte")
        .groupBy(*keys, count_name, "parte", "partes")
        .agg(F.sort_array(F.flatten(F.collect_list(copies))).alias(name))
    )
