"""Append loads as functions of target and batch, and the audit of loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.functions.hashing import content_hash
from chronomart.operators.rows import dedupe_by_key
from chronomart.sources.tables import write_counted

#: Copies of one row that one task adds at a time.
COPIES = 1 << 16


def append_all(target: DataFrame, batch: DataFrame, evolve: bool = True) -> DataFrame:
    """Target plus every row of the batch. With ``evolve``, columns known to one side only
    are null on the other; without it both sides need the same columns."""
    return target.unionByName(batch, allowMissingColumns=evolve)


def new_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the batch that the target does not hold yet.

    With ``keys`` (null matching null) a key is known or added once. Without keys equal rows are
    facts of their own: of each row, recognised by a hash of its whole content (read from a ``_hash``
    column where a side has one), as many copies are added as the batch has more than the target.
    Only the keys or the hash of the target take part, made distinct or counted before the shuffle,
    so a value repeated all over the target stays one row. Rows with very many copies to add are dealt out to
    all tasks, a bounded number of copies at a time.
    """
    if keys:
        known = target.select(F.struct(*keys).alias("_known")).distinct()
        marked = dedupe_by_key(batch.withColumn("_known", F.struct(*keys)), ["_known"])
        return marked.join(known, "_known", "left_anti").drop("_known")

    def mark(df: DataFrame) -> Column:
        return F.col("_hash") if "_hash" in df.columns else content_hash(df.columns)

    held = target.select(mark(target).alias("_known")).groupBy("_known").agg(F.count("*").alias("_held"))
    come = (
        batch.select(mark(batch).alias("_known"), F.struct("*").alias("_row"))
        .groupBy("_known")
        .agg(F.first("_row").alias("_row"), F.count("*").alias("_come"))
    )
    more = F.col("_come") - F.coalesce("_held", F.lit(0))
    added = come.join(held, "_known", "left").withColumn("_more", more)
    few = added.where(F.col("_more").between(1, COPIES)).select("_row", F.col("_more").alias("_copies"))
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("_more") - 1, F.lit(COPIES).cast("bigint"))
    many = (
        added.where((F.col("_come") > COPIES) & (F.col("_more") > COPIES))
        .select("_known", "_row", "_more", F.explode(begins).alias("_begin"))
        # A fixed number: the rows are few and small until they are copied, and would be put together again.
        .repartition(batch.sparkSession.sparkContext.defaultParallelism, "_known", "_begin")
        .select("_row", F.least(F.lit(COPIES), F.col("_more") - F.col("_begin")).alias("_copies"))
    )
    return (
        few.unionByName(many)
        .select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
        .select("_row.*")
    )


def append_new(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Target plus the rows of :func:`new_rows`; loading the same batch again adds nothing."""
    return target.unionByName(new_rows(target, batch, keys), allowMissingColumns=True)


def load_audit(
    spark: SparkSession, tables: Mapping[str, tuple[DataFrame | None, str]]
) -> DataFrame:
    """One row per table: all rows, current rows (history tables), strategy, and ``ok`` or
    ``error`` when the table is missing. Each table is read once, for both counts."""

    def line(name: str, df: DataFrame | None, strategy: str) -> DataFrame:
        unknown = F.lit(None).cast("bigint")
        if df is None:
            counts = spark.range(1).select(unknown.alias("total"), unknown.alias("ativos"))
        else:
            active = F.count_if(F.col("is_current")) if "is_current" in df.columns else unknown
            counts = df.agg(F.count("*").alias("total"), active.alias("ativos"))
        return counts.select(
            F.lit(name).alias("tabela"),
            "total",
            "ativos",
            F.lit(strategy).alias("estrategia"),
            F.lit("error" if df is None else "ok").alias("situacao"),
        )

    return reduce(
        DataFrame.unionByName, [line(name, df, strategy) for name, (df, strategy) in tables.items()]
    )


def audited_loads(
    spark: SparkSession, root: str, tables: Mapping[str, tuple[DataFrame | None, str]]
) -> DataFrame:
    """Write each table to a folder of its own under ``root`` and report the lines of :func:`load_audit`.

    The counts are observed while the rows are written: one job a table, and nothing is read back.
    """
    lines = []
    for name, (df, strategy) in tables.items():
        if df is None:
            lines.append((name, None, None, strategy, "error"))
            continue
        counts = {"total": F.lit(True)}
        if "is_current" in df.columns:
            counts["ativos"] = F.col("is_current")
        found = write_counted(df, f"{root.rstrip('/')}/{name}", counts)
        lines.append((name, found["total"], found.get("ativos"), strategy, "ok"))
    return spark.createDataFrame(lines, "tabela string, total bigint, ativos bigint, estrategia string, situacao string")
