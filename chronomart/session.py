"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Sized by the cluster, not by this library: shuffle partitions only set the upper
# bound, adaptive execution merges small ones and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Joins whose build partitions turn out small are hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # A load writes at most three kinds of rows; open writers for all of them save the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(app_name: str = "chronomart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only a local master may fall back
    to a temporary folder, because there the driver and the tasks share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="chronomart-")
    return _local_scratch[app]


_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing else writes there."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes on leaving what was written to scratch paths within. Results that read from there must
    have been written or collected before."""
    start = len(_written)
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _written[start:]:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        del _written[start:]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back. Runs a job at once; the files
    stay until a surrounding :func:`scratch_scope` ends.

    For a result that several branches of a plan use: they would each compute it again. Unlike a
    cache it survives the loss of executors, and unlike a checkpoint it is columnar and has a
    known size, by which joins with it are chosen.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
