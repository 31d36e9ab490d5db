"""Surrogate keys that are kept: a table of values and dense numbers that later loads only add to.

A value keeps the number it got first. Unseen values are numbered on from the last number in the order of
their values, by ranges, so no task sees all of them; two values can never share a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.operators.ranks import with_positions


def new_keys(known: DataFrame | None, values: DataFrame, column: str, key: str = "key") -> DataFrame:
    """``(column, key)`` of the values that ``known`` does not have yet, null left out.

    Values are made distinct before the join; of ``known`` only the column is read, and its greatest number.
    Without ``known`` numbers start at 1.
    """
    unseen = values.where(F.col(column).isNotNull()).select(column).distinct()
    if known is None:
        return with_positions(unseen, [column], name=key)
    numbered = with_positions(unseen.join(known.select(column), column, "left_anti"), [column], name="_new")
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    return numbered.select(column, (F.col("_new") + last).alias(key))


def extend_keys(known: DataFrame | None, values: DataFrame, column: str, key: str = "key") -> DataFrame:
    """``known`` with the :func:`new_keys` added. Applied to the same values again it adds nothing."""
    added = new_keys(known, values, column, key)
    return added if known is None else known.select(column, F.col(key).cast("long").alias(key)).unionByName(added)


def with_key(df: DataFrame, known: DataFrame, column: str, key: str = "key") -> DataFrame:
    """``df`` with the number of its ``column``; null for null and for values without a number."""
    return df.join(known.select(column, key), column, "left").select(*[F.col(f"`{c}`") for c in df.columns], key)
