"""Records of paged responses, from a table of pages ``(source..., page, status, dados, links)``.

A reader walks pages 1, 2, ... and stops at the first one that is missing, failed or is empty (all left
out) or names no next page (kept). Here that rule is one aggregate per source and a filter, so
all sources are read at once. A page stored twice is one page.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.functions.arrays import has_next
from chronomart.operators.rows import current_rows, dedupe_by_key

OK = 200


def _delivered():
    return F.col("status").eqNullSafe(OK) & (F.coalesce(F.size("dados"), F.lit(0)) > 0)


def accepted_pages(pages: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """The pages a reader of each source would have taken, all columns kept.

    Only ``(source, page)`` of stopping pages reaches the aggregate, which combines before
    its shuffle; a source holding a large share of all pages is joined as a skewed stream
    side and may be split. A page whose predecessor is missing is found by an anti join on
    (source, page - 1), so no source has to sit in one task for it. Without ``by`` all
    pages are of one source.
    """
    place = [*by, "page"]
    pages = dedupe_by_key(pages, place)
    stops_here = (
        pages.where(~_delivered() | ~has_next("links"))
        # The first page a reader would not take: this one, or the next if this one is the last.
        .select(*by, F.when(_delivered(), F.col("page") + 1).otherwise(F.col("page")).alias("_stop"))
    )
    numbers = pages.select(*place)
    after = numbers.select(*by, (F.col("page") + 1).alias("page"))
    gaps = numbers.where("page > 1").join(after, place, "left_anti").select(*by, F.col("page").alias("_stop"))
    stops = stops_here.unionByName(gaps)
    if by:
        marked = pages.join(stops.groupBy(*by).agg(F.min("_stop").alias("_stop")), list(by), "left")
    else:
        marked = pages.withColumn("_stop", stops.agg(F.min("_stop")).scalar())
    in_reach = F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))
    return marked.where((F.col("page") >= 1) & in_reach).drop("_stop")


def _records(pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    return pages.select(*keep, F.inline("dados"))


def collect_pages(
    pages: DataFrame, by: Sequence[str] = ("source",), first_only: bool = False
) -> DataFrame:
    """Records of every accepted page, with the source columns in front.

    ``first_only`` takes page 1 alone and ignores links; a failed page 1 gives no rows.
    """
    if first_only:
        first = dedupe_by_key(pages.where("page = 1"), [*by, "page"])
        return _records(first.where(_delivered()), by)
    return _records(accepted_pages(pages, by), by)


def collect_child_pages(
    pages: DataFrame,
    parents: DataFrame,
    parent_key: str,
    inject: Mapping[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Records of pages requested per parent, with parent columns written into each record.

    ``inject`` maps a parent column to its name in the result. Pages of unknown parents
    are dropped, as nobody would have asked for them. Of a parent table with history the current
    rows count; a parent given more than once is one parent.
    """
    if "is_current" in parents.columns:
        parents = current_rows(parents)
    parents = dedupe_by_key(parents.select(*dict.fromkeys([parent_key, *inject])), [parent_key])
    taken = accepted_pages(pages, (*by, parent_key))
    extra = [c for c in inject if c != parent_key]
    if extra:
        taken = taken.join(parents.select(parent_key, *extra), parent_key)
    else:
        taken = taken.join(parents.select(parent_key), parent_key, "left_semi")
    return taken.select(
        *by, *[F.col(c).alias(name) for c, name in inject.items()], F.inline("dados")
    )


def collect_yearly(pages: DataFrame) -> DataFrame:
    """Records of single-page responses, one response per ``year``."""
    return collect_pages(pages, by=("year",), first_only=True)


def yearly_gaps(pages: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per requested year: number of records received and whether there was none."""
    spark = pages.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(y) for y in years])).alias("year")
    )
    received = (
        pages.where((F.col("page") == 1) & _delivered())
        .groupBy("year")
        .agg(F.sum(F.size("dados")).alias("records"))
    )
    return wanted.join(received, "year", "left").select(
        "year",
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        F.col("records").isNull().alias("is_empty"),
    )
