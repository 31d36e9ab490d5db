"""Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_bronze(df: DataFrame, path: str) -> bool:
    """Replace a Parquet folder; an empty result writes nothing and returns False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Write a catalog table; ``path`` makes it external, outside the warehouse folder."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_counted(
    df: DataFrame, path: str, counts: Mapping[str, Column] | None = None, *partitions: str
) -> dict[str, int]:
    """Replace a Parquet folder and return how many of the rows written meet each condition of ``counts``
    (without any, ``rows``: all of them).

    The counts are observed on the written plan, in the same job; nothing is read again.
    """
    seen = Observation()
    wanted = {name: F.count_if(F.coalesce(c, F.lit(False))) for name, c in (counts or {"rows": F.lit(True)}).items()}
    observed = df.observe(seen, *[c.alias(name) for name, c in wanted.items()])
    observed.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return {name: int(seen.get.get(name) or 0) for name in wanted}
