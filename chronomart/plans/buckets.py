"""History laid out by key, so that a load writes what it touches.

Current rows lie in partitions by a hash of their key, closed versions in partitions by load and key hash. A load
compares the snapshot with the current rows, stages the difference, and rewrites only the partitions that hold
a changed key, by Spark's dynamic partition overwrite; untouched partitions are neither written nor read again.

A load that died may be run again with the same day: closed versions are written first and by (load, key hash), so a
second run writes the same ones again, and partitions that the first run had replaced no longer differ. One
writer at a time; readers between loads.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.operators.history import CLOSE, INSERT, KEEP, first_load, snapshot_changes
from chronomart.operators.rows import dedupe_by_key
from chronomart.session import materialise

#: Partition columns: the number of buckets of the table, a row's bucket, and the load that closed it.
OF, BUCKET, LOAD = "_of", "_bucket", "_load"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A key's bucket; null parts of a key count."""
    return F.pmod(F.xxhash64(F.struct(*keys)), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, with the columns of all its files; None if there is none."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current rows; closed versions are not opened."""
    current = _read(spark, f"{path}/current")
    if current is None:
        raise LookupError(f"no history in {path}")
    return current.drop(OF, BUCKET)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions."""
    current, closed = read_current(spark, path), _read(spark, f"{path}/closed")
    return current if closed is None else current.unionByName(closed.drop(LOAD, OF, BUCKET), allowMissingColumns=True)


def _overwrite(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``rows`` has rows in; all others stay as they are."""
    dealt = rows.repartition(*by)  # one file a partition
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _counts(rows: DataFrame) -> dict[str, int]:
    found = {r["_change"]: r["count"] for r in rows.groupBy("_change").count().collect()}  # at most two rows
    return {INSERT: found.get(INSERT, 0), CLOSE: found.get(CLOSE, 0)}


def load(
    spark: SparkSession,
    path: str,
    stamped: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | str,
    buckets: int = 64,
    close_missing: bool = False,
) -> dict[str, int]:
    """Load a stamped snapshot; returns the rows inserted, closed and rewritten (``keep``).

    ``buckets`` counts for the first load only. A snapshot without a change writes nothing. Null parts of
    keys match each other; repeated keys of a snapshot are reduced to one row.
    """
    path = path.rstrip("/")
    current = _read(spark, f"{path}/current")
    if current is None:
        rows = first_load(stamped, keys).withColumns({OF: F.lit(buckets), BUCKET: bucket_of(keys, buckets)})
        staged = materialise(rows, "staged")
        _overwrite(staged, f"{path}/current", OF, BUCKET)
        return {INSERT: staged.count(), CLOSE: 0, KEEP: 0}

    first = current.select(OF).first()
    of = buckets if first is None else first[0]
    place = {OF: F.lit(of), BUCKET: bucket_of(keys, of)}
    changes = snapshot_changes(current.drop(OF, BUCKET), stamped, keys, as_of, close_missing)
    delta = materialise(changes.where(F.col("_change") != KEEP).withColumns(place), "delta")
    counts = _counts(delta)
    if not any(counts.values()):
        return {**counts, KEEP: 0}

    touched = [r[0] for r in delta.select(BUCKET).distinct().collect()]  # at most one row a bucket
    key = F.struct(*keys).alias("_key")  # structs compare nulls as equal
    gone = delta.where(F.col("_change") == CLOSE).select(key)
    kept = current.where(F.col(BUCKET).isin(touched)).withColumn("_key", key).join(gone, "_key", "left_anti").drop("_key")
    fresh = delta.where(F.col("_change") == INSERT).drop("_change")
    staged = materialise(kept.unionByName(fresh, allowMissingColumns=True), "staged")

    closed = delta.where(F.col("_change") == CLOSE).drop("_change").withColumn(LOAD, F.lit(str(as_of)))
    if counts[CLOSE]:
        _overwrite(closed, f"{path}/closed", LOAD, OF, BUCKET)
    emptied = _emptied(staged, touched, spark)
    _overwrite(staged, f"{path}/current", OF, BUCKET)
    for bucket in emptied:
        _remove(spark, f"{path}/current/{OF}={of}/{BUCKET}={bucket}")
    return {**counts, KEEP: staged.count() - counts[INSERT]}


def _emptied(staged: DataFrame, touched: list[int], spark: SparkSession) -> list[int]:
    """Touched buckets in which no row is current any more: an overwrite by rows does not reach them."""
    held = {r[0] for r in staged.select(BUCKET).distinct().collect()}
    return [b for b in touched if b not in held]


def _remove(spark: SparkSession, folder: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def load_all(
    spark: SparkSession, path: str, snapshots: Sequence[tuple[DataFrame, dt.date | str]], keys: Sequence[str], **options
) -> DataFrame:
    """Load stamped snapshots one after the other and read the history."""
    for stamped, as_of in snapshots:
        load(spark, path, dedupe_by_key(stamped, keys), keys, as_of, **options)
    return read_history(spark, path)
