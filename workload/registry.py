"""Registration of a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    text: Sequence[str]


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None, text: Sequence[str] = ()):
    """Register a query. Columns in ``text`` (dates, timestamps, decimals) are compared by their
    text, the same on both sides."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(run, sql, tuple(text))
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(entry: Entry):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = entry.run(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c in entry.text})

        return run

    return {name: bound(entry) for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, entry in ENTRIES.items():
        if entry.sql is None:
            continue
        sql = entry.sql.strip()
        if entry.text:
            casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in entry.text)
            sql = f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n)"
        out[name] = sql
    return out
