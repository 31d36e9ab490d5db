"""Arrays of records and delimited id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronomart.functions.parsing import to_int


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_as_int(records: str | Column, field: str = "id") -> Column:
    """One integer per record of an array of structs; values that are no integer give null."""
    return F.transform(_col(records), lambda r: to_int(r[field]))


def join_ids(ids: str | Column, separator: str = ",") -> Column:
    """``[1, null, 3]`` to ``'1,3'``; a null array stays null."""
    return F.array_join(_col(ids), separator)


def split_ids(text: str | Column, separator: str = ",") -> Column:
    """Inverse of :func:`join_ids`; empty text gives an empty array."""
    c = _col(text)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, separator))


def has_next(links: str | Column) -> Column:
    """Whether a page's link list names a following page."""
    return F.coalesce(F.exists(_col(links), lambda link: link["rel"] == "next"), F.lit(False))
