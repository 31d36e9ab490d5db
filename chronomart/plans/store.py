"""Versioned Parquet tables: every load adds files and one log row, nothing is rewritten in place.

A load writes ``<root>/<table>/v=<n>/_change=<insert|keep|close>/`` and then appends a row to
``<root>/_load_log/table=<table>`` that names the folders which now make up the table. Readers follow the log,
so a table may be read while its next version is written, and a load that dies half-way leaves
folders no log row points to (the next attempt overwrites them).

What a load has to write differs by kind: an append writes the new rows only; a history load
writes current and newly closed rows, while versions closed by earlier loads keep their files.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.functions.hashing import content_hash
from chronomart.operators.history import CLOSE, INSERT, KEEP, first_load, snapshot_changes
from chronomart.operators.loads import new_rows
from chronomart.operators.promotion import conform, misfits
from chronomart.operators.rows import dedupe_by_key
from chronomart.sources.tables import write_counted

LOG_SCHEMA = (
    "version int, as_of date, loaded_at timestamp, operation string, "
    "rows_inserted bigint, rows_closed bigint, rows_kept bigint, "
    "current array<string>, closed array<string>, schema string"
)


class TableStore:
    """Tables under one folder that all executors can reach. One writer per table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # Reading ----------------------------------------------------------------------------

    def _log_of(self, name: str) -> str:
        # A folder per table, so that loads of different tables may commit at the same time.
        return f"{self.root}/_load_log/table={name}"

    def _entries(self, name: str) -> DataFrame:
        """The table's log, newest load first."""
        try:
            log = self.spark.read.schema(LOG_SCHEMA).json(self._log_of(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log = self.spark.createDataFrame([], LOG_SCHEMA)
        return log.orderBy(F.col("version").desc())

    def _latest(self, name: str) -> Row | None:
        return self._entries(name).limit(1).first()

    def exists(self, name: str) -> bool:
        return self._latest(name) is not None

    def _scan(self, state: Row, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def _state(self, name: str) -> Row:
        state = self._latest(name)
        if state is None:
            raise LookupError(f"no table {name!r} in {self.root}")
        return state

    def read(self, name: str) -> DataFrame:
        """The whole table, history included."""
        state = self._state(name)
        return self._scan(state, [*state["current"], *state["closed"]])

    def read_current(self, name: str) -> DataFrame:
        """Current rows only; the files of closed versions are not opened."""
        state = self._state(name)
        return self._scan(state, state["current"])

    def register(self, *names: str) -> None:
        """Make tables available to SQL under their names, as they are after their last load."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    def load_history(self, name: str, last: int = 5) -> DataFrame:
        """The last loads of a table, newest first."""
        return self._entries(name).limit(last).select(
            "version", "loaded_at", "as_of", "operation", "rows_inserted", "rows_closed", "rows_kept"
        )

    # Writing ----------------------------------------------------------------------------

    def _publish(
        self,
        name: str,
        rows: DataFrame,
        operation: str,
        as_of: dt.date | str,
        state: Row | None,
        keep_current: bool = False,
    ) -> dict[str, int]:
        """Write rows that carry ``_change``, or else are all inserted, counting them on the way, and log the version.

        The counts are observed in the tasks that write the files, each of which counts once however often
        it had to be run; the files are not read again. A load that changed nothing is not logged.
        """
        version = 1 if state is None else state["version"] + 1
        folder = f"{name}/v={version:06d}"
        data = T.StructType([f for f in rows.schema.fields if f.name != "_change"])
        if "_change" in rows.columns:
            counts = write_counted(
                rows, f"{self.root}/{folder}", {c: F.col("_change") == c for c in (INSERT, CLOSE, KEEP)}, "_change"
            )
        else:
            # One kind of rows needs no writer per kind, before which Spark would sort all that a task writes.
            counts = write_counted(rows, f"{self.root}/{folder}/_change={INSERT}", {INSERT: F.lit(True)})
            counts |= {CLOSE: 0, KEEP: 0}
        if operation in ("scd2", "append") and counts[INSERT] + counts[CLOSE] == 0:
            return counts

        here = [f"{folder}/_change={c}" for c in (KEEP, INSERT) if counts[c]]
        closed = [f"{folder}/_change={CLOSE}"] if counts[CLOSE] else []
        if operation == "scd2":
            closed = [*state["closed"], *closed]
        if keep_current:
            here = [*state["current"], *here]
        entry = (
            version, dt.date.fromisoformat(str(as_of)),
            dt.datetime.now(dt.timezone.utc), operation,
            counts[INSERT], counts[CLOSE], counts[KEEP], here, closed, data.json(),
        )
        logged = self.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1)
        logged.write.mode("append").json(self._log_of(name))
        return counts

    def overwrite(self, name: str, df: DataFrame, as_of: dt.date | str) -> dict[str, int]:
        """Replace the table, schema included."""
        return self._publish(name, df, "overwrite", as_of, self._latest(name))

    def load_append(
        self,
        name: str,
        batch: DataFrame,
        as_of: dt.date | str,
        keys: Sequence[str] | None = None,
        only_new: bool = True,
    ) -> dict[str, int]:
        """Add the batch, or with ``only_new`` the rows the table does not hold yet: with keys each
        once, without keys as many copies as the batch has more than the table.

        Without keys the rows keep a content hash in ``_hash``, so that the next load reads that
        one column of the table and not all of them.
        """
        state = self._latest(name)
        if not keys:
            batch = batch.withColumn("_hash", content_hash(batch.columns))
        if state is None:
            added = dedupe_by_key(batch, keys) if only_new and keys else batch
            return self._publish(name, added, "first", as_of, None)
        target = self._scan(state, state["current"])
        kept = misfits(target.schema, batch.schema)
        if kept:
            # The files keep the types they were written with: what does not fit them stands beside its row.
            batch = conform(batch, kept)
        rows = new_rows(target, batch, keys) if only_new else batch
        # Columns known to one side only are null on the other, now and in later reads.
        rows = target.limit(0).unionByName(rows, allowMissingColumns=True)
        return self._publish(name, rows, "append", as_of, state, keep_current=True)

    def load_scd2(
        self,
        name: str,
        stamped: DataFrame,
        keys: Sequence[str],
        as_of: dt.date | str,
        close_missing: bool = False,
        null_safe: bool = True,
    ) -> dict[str, int]:
        """First load or incremental load of a table with history."""
        state = self._latest(name)
        if state is None:
            return self._publish(name, first_load(stamped, keys), "first", as_of, None)
        current = self._scan(state, state["current"])
        changes = snapshot_changes(current, stamped, keys, as_of, close_missing, null_safe)
        return self._publish(name, changes, "scd2", as_of, state)
