"""Results written once to the shared folder, without leaving shuffle files behind."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chronomart.session import materialise

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder; the shuffle files of this job go when it has ended."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN)
    conf.set(CLEAN, "true")
    try:
        return materialise(df, label)
    finally:
        conf.set(CLEAN, before)
