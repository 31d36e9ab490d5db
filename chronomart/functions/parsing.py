"""Parsing of the text columns that arrive from JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp layout of the source records.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
# Fixed value: the date layout of the source records.
ISO_DATE = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, pattern: str = ISO_DATE) -> Column:
    """Date from text; text that does not fit the pattern gives null."""
    return F.try_to_date(_col(c), pattern)


def parse_timestamp_strict(c: str | Column, pattern: str = ISO_SECONDS) -> Column:
    """Timestamp from text; text that does not fit fails the query under ANSI mode."""
    return F.to_timestamp(_col(c), pattern)


def parse_timestamp(c: str | Column, pattern: str | None = ISO_SECONDS) -> Column:
    """Timestamp from text, null when it does not fit.

    With ``pattern=None`` Spark's default reading applies, which also takes
    ``2020-01-01T10:00`` and a plain date.
    """
    if pattern is None:
        return F.try_to_timestamp(_col(c))
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def to_money(c: str | Column, strict: bool = False) -> Column:
    """Amount from text or number, null when it is none; with ``strict`` that fails the query."""
    return _col(c).cast("decimal(18,2)") if strict else _col(c).try_cast("decimal(18,2)")


def to_int(c: str | Column) -> Column:
    """Integer from text, null when it is not one.

    Only text of the right form reaches the cast: each failing cast would raise and catch an
    exception inside Spark, which costs some fifty times the pattern test.
    """
    value = _col(c)
    return F.when(value.cast("string").rlike(r"^\s*[+-]?[0-9]+\s*$"), value.try_cast("int"))


def uri_id(c: str | Column, resource: str) -> Column:
    """The number that follows ``resource/`` in a URI; ``''`` without a match, null for null."""
    return F.regexp_extract(_col(c), rf"{resource}/(\d+)", 1)
