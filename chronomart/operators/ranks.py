"""Places of rows in an order over the whole table, found without one task seeing all rows.

Rows are dealt out by ranges of the order, numbered within their range, and each range starts where the
rows of all ranges before it end. A key that holds many rows is spread over several ranges like any other
part of the order. Rows that the order does not tell apart are told apart by where they were read.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.session import materialise

#: A partition's number stands above this many bits of a row's number.
ROW_BITS = 33


def _ranged(df: DataFrame, order: list[Column], drop: Sequence[str]) -> DataFrame:
    """``df`` sorted by ranges, with the number of each row's range and its place there, without the columns of ``drop``.
    The ranges are sampled, so they are written once: a task that runs again finds the same ones."""
    told_apart = df.withColumn("_read", F.monotonically_increasing_id())
    by = [*order, F.col("_read")]
    numbered = told_apart.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    spread = materialise(numbered.drop("_read", *drop), "ranged")
    return spread.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in drop],
        F.shiftright("_at", ROW_BITS).cast("int").alias("_range"),
        F.col("_at").bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
    )


def with_positions(
    df: DataFrame,
    order: Sequence[Column | str],
    within: Sequence[str] = (),
    name: str = "position",
    drop: Sequence[str] = (),
) -> DataFrame:
    """``df`` with each row's place, from 1 on, in the ``order`` (of all rows, or of those that share ``within``).

    Columns named in ``drop`` serve the order only; they are neither written nor returned. The driver sees one count
    per range. Null keys are one key. Columns ``_read``, ``_at``, ``_range`` and ``_row`` are
    used in between and refused in ``df``.
    """
    taken = {"_read", "_at", "_range", "_row"}.intersection(c.lower() for c in df.columns)
    if taken or name in df.columns:
        raise ValueError(f"columns {sorted(taken) or [name]} are needed for positions")
    columns = [F.col(f"`{c}`") for c in df.columns if c not in drop]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [F.col(f"`{c}`") for c in within]
    spread = _ranged(df, [*keys, *order], drop)
    if not within:
        return _with_starts(spread).select(*columns, (F.col("_start") + F.col("_row") + 1).alias(name))
    here = Window.partitionBy("_range", *keys).orderBy("_row")
    placed = spread.withColumn("_here", F.row_number().over(here).cast("long"))
    key = F.struct(*keys).alias("_key")  # structs compare nulls as equal
    counts = spread.groupBy(key, "_range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # Only keys that reach over a border have rows in an earlier range: at most one a range.
    carried = counts.withColumn("_start", F.sum("n").over(earlier)).where("_start is not null").drop("n")
    joined = placed.withColumn("_key", key).join(carried, ["_key", "_range"], "left")
    return joined.select(*columns, (F.coalesce("_start", F.lit(0)) + F.col("_here")).alias(name))


def _with_starts(spread: DataFrame) -> DataFrame:
    """How many rows stand in the ranges before each row's own."""
    counts = sorted(spread.groupBy("_range").count().collect())  # one row per range
    starts = [0, *accumulate(n for _, n in counts)]
    rows = [(part, start) for (part, _), start in zip(counts, starts)]
    table = spread.sparkSession.createDataFrame(rows, "_range int, _start long")
    return spread.join(F.broadcast(table), "_range")
