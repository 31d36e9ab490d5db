"""Row history (slowly changing dimension, type 2) as pure functions of target and snapshot.

A table with history has four columns besides its own: ``data_inicio``, ``data_fim`` (the row
held from the first up to, not including, the second), ``is_current`` and ``_hash``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.functions.hashing import row_hash
from chronomart.operators.rows import current_rows, dedupe_by_key, update_where
from chronomart.sources.records import ensure_columns

HISTORY_COLUMNS = {
    "data_inicio": "date",
    "data_fim": "date",
    "is_current": "boolean",
    "_hash": "string",
}

KEEP, CLOSE, INSERT = "keep", "close", "insert"


def _day(as_of: dt.date | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def stamp(
    df: DataFrame,
    tracked: Sequence[str],
    as_of: dt.date | str | Column,
    hash_mode: str = "mark_nulls",
) -> DataFrame:
    """A snapshot with history columns: valid from ``as_of``, open, current, hashed."""
    return df.withColumns(
        {
            "data_inicio": _day(as_of),
            "data_fim": F.lit(None).cast("date"),
            "is_current": F.lit(True),
            "_hash": row_hash(tracked, hash_mode),
        }
    )


def upgrade_to_history(
    df: DataFrame,
    tracked: Sequence[str],
    as_of: dt.date | str | Column,
    hash_mode: str = "mark_nulls",
) -> DataFrame:
    """Give a table history columns and make each row without a state a current one."""
    return update_where(
        ensure_columns(df, HISTORY_COLUMNS),
        F.col("is_current").isNull(),
        {
            "data_inicio": _day(as_of),
            "_hash": row_hash(tracked, hash_mode),
            "is_current": F.lit(True),
        },
    )


def first_load(stamped: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dedupe_by_key(stamped, keys)


def _aligned(target: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns and types that their union by name would have."""
    merged = (
        target.limit(0).unionByName(snapshot.limit(0), allowMissingColumns=True).schema
    )

    def fit(df: DataFrame) -> DataFrame:
        have = {c.lower(): c for c in df.columns}
        return df.select(
            *[
                (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in merged.fields
            ]
        )

    return fit(target), fit(snapshot)


def snapshot_changes(
    current: DataFrame,
    stamped: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | str | Column,
    close_missing: bool = False,
    null_safe: bool = True,
) -> DataFrame:
    """What a snapshot does to the current rows: each result row carries ``_change``.

    ``keep``: current row that stays; ``close``: current row whose hash differs in the snapshot
    (or, with ``close_missing``, whose key is absent from it); ``insert``: snapshot row with a
    new key or a changed hash. Repeated snapshot keys are reduced to one row first.

    One full outer join on the keys does it, so each side is shuffled once. The keys are joined as
    one struct: structs with null fields compare equal, so a key that is partly null has one current
    row like any other, and the struct also serves the removal of repeated keys, which therefore needs
    no shuffle of its own. ``null_safe=False`` is the literal merge, in which a null key matches
    nothing and is inserted again by every snapshot.

    A snapshot older than an open version that it would close is refused when the plan runs: the
    version would end before it began.
    """
    old, new = _aligned(current, stamped)
    columns = old.columns
    if null_safe:
        pack = F.struct(*[F.col(k) for k in keys])
        old, new, join_keys = old.withColumn("_key", pack), new.withColumn("_key", pack), ["_key"]
    else:
        join_keys = list(keys)
    new = dedupe_by_key(new, join_keys)

    def packed(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"_{side}{i}") for i, k in enumerate(join_keys)],
            F.struct(*columns).alias(side),
        )

    match = F.lit(True)
    for i in range(len(join_keys)):
        match = match & (F.col(f"_old{i}") == F.col(f"_new{i}"))
    both = packed(old, "old").join(packed(new, "new"), match, "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = has_old & has_new & ~F.col("old._hash").eqNullSafe(F.col("new._hash"))
    closing = (changed | (has_old & ~has_new)) if close_missing else changed

    def version(side: str, change: Column, ends: bool = False) -> Column:
        """The side's row; for an old row that closes, with its end written in."""
        fields = []
        for c in columns:
            value = F.col(f"{side}.{c}")
            if ends and c == "data_fim":
                late = F.col(f"{side}.data_inicio") > _day(as_of)
                refuse = F.raise_error(F.lit("the snapshot is older than the version it closes")).cast("date")
                value = F.when(closing & late, refuse).when(closing, _day(as_of)).otherwise(value)
            elif ends and c == "is_current":
                value = F.when(closing, F.lit(False)).otherwise(value)
            fields.append(value.alias(c))
        return F.struct(*fields, change.alias("_change"))

    before = F.when(
        has_old, version("old", F.when(closing, F.lit(CLOSE)).otherwise(F.lit(KEEP)), ends=True)
    )
    after = F.when(has_new & (~has_old | changed), version("new", F.lit(INSERT)))
    # A version that does not exist is a null element; as a filter this stays generated code, which
    # removing nulls from the array would not.
    return both.select(F.inline(F.array(before, after))).where(F.col("_change").isNotNull())


def apply_scd2(
    target: DataFrame,
    stamped: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | str | Column,
    close_missing: bool = False,
    null_safe: bool = True,
) -> DataFrame:
    """The table with history after a snapshot. Closed versions pass through unshuffled, and
    applying the same snapshot again changes nothing.

    The result reads ``target`` twice, once for the open and once for the closed versions. Write it
    before the next snapshot is applied: chained plans would double with every one.
    """
    changes = snapshot_changes(
        target.where(F.col("is_current")), stamped, keys, as_of, close_missing, null_safe
    )
    closed = target.where(~F.coalesce(F.col("is_current"), F.lit(False)))
    return closed.unionByName(changes.drop("_change"), allowMissingColumns=True)


def change_summary(changes: DataFrame) -> DataFrame:
    """Counts of :func:`snapshot_changes`, from the change set and not from the written table:
    one row ``(closed, inserted, kept, message)``."""
    counted = changes.agg(
        F.count_if(F.col("_change") == CLOSE).alias("closed"),
        F.count_if(F.col("_change") == INSERT).alias("inserted"),
        F.count_if(F.col("_change") == KEEP).alias("kept"),
    )
    return counted.withColumn(
        "message",
        F.when(
            F.col("inserted") + F.col("closed") > 0,
            F.concat(F.col("inserted").cast("string"), F.lit(" rows applied")),
        ).otherwise(F.lit("no change")),
    )


# Questions over a table with history.


def current(df: DataFrame) -> DataFrame:
    return current_rows(df)


def timeline(df: DataFrame, key: str, value: object, columns: Sequence[str]) -> DataFrame:
    """All versions of one entity, newest first."""
    return (
        df.where(F.col(key) == F.lit(value)).select(*columns).orderBy(F.col("data_inicio").desc())
    )


def as_of(df: DataFrame, day: dt.date | str | Column) -> DataFrame:
    """The rows that held on ``day``. A version closed on the day it began held on no day."""
    d = _day(day)
    return df.where(
        (F.col("data_inicio") <= d) & (F.col("data_fim").isNull() | (F.col("data_fim") > d))
    )


def changed_since(df: DataFrame, today: dt.date | str | Column, days: int = 7) -> DataFrame:
    """Versions that began in the last ``days`` days."""
    return df.where(F.col("data_inicio") >= F.date_sub(_day(today), days))


def version_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Entities with more than one version and how many they have."""
    return df.groupBy(*by).agg(F.count("*").alias("num_versoes")).where("num_versoes > 1")


def version_durations(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    today: dt.date | str | Column,
    k: int | None = 20,
    order_by: Sequence[str] = ("nome",),
) -> DataFrame:
    """Versions of entities that changed at least once, with the days each one lasted
    (open versions run to ``today``); the first ``k`` by ``order_by``, newest version first."""
    several = df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    rows = df.join(several, key, "left_semi").select(
        key,
        *[c for c in columns if c != key],
        "data_inicio",
        "data_fim",
        "is_current",
        F.datediff(F.coalesce(F.col("data_fim"), _day(today)), F.col("data_inicio")).alias("dias"),
    )
    if k is None:
        return rows
    return rows.orderBy(
        *[F.col(c).asc() for c in order_by], F.col("data_inicio").desc(), F.col(key)
    ).limit(k)
