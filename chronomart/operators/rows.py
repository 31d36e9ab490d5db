"""Row-level operators: one row per key, conditional update, matched update, latest row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _orderable(field: T.StructField) -> Column:
    # Spark cannot order maps (nor variants), so those compare by their JSON text.
    if "map<" in field.dataType.simpleString() or field.dataType.typeName() == "variant":
        return F.to_json(F.struct(F.col(f"`{field.name}`")))
    return F.col(f"`{field.name}`")


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key (null is a key value like any other).

    The survivor is the first by ``order_by`` and then by all other columns in their order,
    nulls first, so the same rows give the same survivor whatever the partitioning. Because
    only rank 1 is kept, Spark limits each key before the shuffle as well as after it: a key
    that holds a large share of all rows sends one row per input task, not all of them.
    """
    key_names = {k.lower() for k in keys}
    rest = [_orderable(f).asc_nulls_first() for f in df.schema.fields if f.name.lower() not in key_names]
    order = [*(order_by or []), *rest] or [F.lit(1).asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE condition``: a null condition leaves the row as it is."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in assignments.items()}
    )


def key_match(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Equality of all ``keys`` between two aliased relations."""
    match = F.lit(True)
    for k in keys:
        a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        match = match & (a.eqNullSafe(b) if null_safe else a == b)
    return match


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    when: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Merge with a matched-update clause only: rows of ``target`` that find their key in
    ``source`` (and meet ``when``) are updated, all others kept.

    Expressions may use ``target.`` and ``source.`` columns. Repeated source keys are reduced
    to one row first, so no target row is multiplied.
    """
    matched = F.col("source._matched").isNotNull()
    if when is not None:
        matched = matched & F.coalesce(when, F.lit(False))
    joined = target.alias("target").join(
        dedupe_by_key(source, keys).withColumn("_matched", F.lit(True)).alias("source"),
        key_match("target", "source", keys, null_safe),
        "left",
    )
    assigned = {name.lower(): value for name, value in assignments.items()}
    return joined.select(
        *[
            F.when(matched, assigned[c.lower()]).otherwise(F.col(f"target.{c}")).alias(c)
            if c.lower() in assigned
            else F.col(f"target.{c}")
            for c in target.columns
        ]
    )


def changed_or_new(
    source: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    hash_column: str = "_hash",
) -> DataFrame:
    """Rows of ``source`` whose key is not in ``current`` or has another hash there.

    Only keys and hash of ``current`` take part in the join.
    """
    seen = current.select(*keys, hash_column).withColumn("_seen", F.lit(True))
    return (
        source.alias("source")
        .join(seen.alias("target"), key_match("source", "target", keys, null_safe), "left")
        .where(
            F.col("target._seen").isNull()
            | ~F.col(f"target.{hash_column}").eqNullSafe(F.col(f"source.{hash_column}"))
        )
        .select("source.*")
    )


def latest_by(df: DataFrame, value: str, order: str) -> Column:
    """The ``value`` of the row with the greatest ``order`` (then greatest value), as a scalar
    subquery: nothing comes to the driver, and an empty ``df`` gives null."""
    return (
        df.where(F.col(order).isNotNull())
        .agg(F.max(F.struct(F.col(order).alias("_o"), F.col(value).alias("_v"))).alias("_m"))
        .select("_m._v")
        .scalar()
    )


def current_rows(df: DataFrame) -> DataFrame:
    """Current versions of a table with history; a table without history as it is."""
    return df.where(F.col("is_current")) if "is_current" in df.columns else df
