"""Row hashes and portable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def row_hash(columns: Sequence[str | Column], mode: str = "mark_nulls") -> Column:
    """MD5 over the text of ``columns`` joined by ``|``.

    ``mark_nulls`` writes a marker for null, so a value moving from one column to its null
    neighbour changes the hash. ``skip_nulls`` drops nulls before joining, which gives
    ``(a, null, b)`` and ``(a, b, null)`` the same hash.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    if mode == "mark_nulls":
        parts = [F.coalesce(p, F.lit(NULL_MARK)) for p in parts]
    elif mode != "skip_nulls":
        raise ValueError(f"unknown hash mode {mode!r}")
    return F.md5(F.concat_ws("|", *parts))


def content_hash(columns: Sequence[str]) -> Column:
    """MD5 of a row's non-null values with their names, whatever the order of the columns.

    Null fields take no part, so a row keeps its hash when its table gains a column.
    """
    exact = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), exact))


def stable_key(column: str | Column) -> Column:
    """A 60-bit key that depends on the value alone.

    Unlike ids numbered within a partition it does not move when data is added or
    repartitioned, and unlike a global ``row_number`` it needs no single sorted task.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
