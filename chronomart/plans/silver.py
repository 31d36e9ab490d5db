"""From raw records to the typed tables of the store: one load per entity, by its strategy."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from chronomart.operators import cleaning
from chronomart.operators.history import stamp
from chronomart.operators.loads import load_audit
from chronomart.plans.entities import (
    APPEND,
    CHILD,
    ENTITIES,
    FILES,
    OVERWRITE,
    PAGED,
    SINGLE,
    YEAR_PAGES,
    YEARLY,
    Entity,
)
from chronomart.plans.store import TableStore
from chronomart.sources import envelopes, pages
from chronomart.sources.records import drop_void, flatten_structs
from chronomart.sources.tables import write_bronze


def read_files(
    spark: SparkSession, entity: Entity, path: str, as_of: dt.date, multi_line: bool = True
) -> DataFrame:
    """Raw records of an entity that arrives as files: all of them, or those of the last eight
    years. Fields that the entity does not declare are kept in ``_extra``."""
    if YEARLY in entity.ways:
        return envelopes.read_year_window(
            spark, path, entity.record, as_of.year, multi_line=multi_line, whole=True
        )
    if FILES in entity.ways:
        return envelopes.read_envelopes(spark, path, entity.record, multi_line=multi_line, whole=True)
    raise ValueError(f"{entity.name} arrives as {', '.join(entity.ways)}")


def read_pages(entity: Entity, page_table: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Raw records of an entity that arrives as pages ``(page, status, dados, links)``: in pages by ``year`` of one
    response each, in pages per parent, which the parent's key names, or in one run of pages.

    ``parents(id, ...)`` are the parents asked for; what the entity's parent says is written into the records.
    """
    if CHILD in entity.ways and (parents is not None or entity.arrives == CHILD):
        parent = entity.parent
        known = parents.withColumnRenamed("id", parent.key)
        rows = pages.collect_child_pages(page_table, known, parent.key, {parent.key: parent.key, **parent.inject})
        taken = set(parent.rename.values()) - parent.rename.keys()
        rows = rows.drop(*taken)  # fields that a rename fills
        return rows.toDF(*[parent.rename.get(c, c) for c in rows.columns])
    if YEAR_PAGES in entity.ways and "year" in page_table.columns:
        return pages.collect_yearly(page_table).drop("year")
    if PAGED in entity.ways or SINGLE in entity.ways:
        return pages.collect_pages(page_table, by=(), first_only=entity.arrives == SINGLE)
    raise ValueError(f"{entity.name} arrives as {', '.join(entity.ways)}")


def land(entity: Entity, raw: DataFrame, folder: str) -> bool:
    """Keep a snapshot as it came, flattened, in a Parquet folder of the entity's own, replacing
    the one before; an empty snapshot writes nothing. :func:`run_load` takes either form."""
    return write_bronze(drop_void(flatten_structs(raw)), f"{folder.rstrip('/')}/{entity.name}")


def cleaned(entity: Entity, raw: DataFrame) -> DataFrame:
    return entity.clean(drop_void(flatten_structs(raw)))


def cleaned_with_rejects(entity: Entity, raw: DataFrame) -> DataFrame:
    """The cleaned records with the values that cleaning made null beside them, in ``_rejects``; timestamps that do
    not parse are among them, also where :func:`run_load` would fail on them."""
    clean = entity.clean
    if clean is cleaning.clean_bills:
        clean = partial(cleaning.clean_bills, strict=False)
    return cleaning.with_rejects(clean, drop_void(flatten_structs(raw)))


def run_load(
    store: TableStore, entity: Entity | str, raw: DataFrame, as_of: dt.date | str
) -> dict[str, int]:
    """Clean and load one snapshot; returns the rows inserted, closed and kept.

    The first load creates the table, an empty snapshot writes nothing. An append adds the
    records the table does not hold yet.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    rows = cleaned(entity, raw)
    if raw.isEmpty():
        return {"insert": 0, "close": 0, "keep": 0}
    if entity.strategy == OVERWRITE:
        return store.overwrite(entity.name, rows, as_of)
    if entity.strategy == APPEND:
        return store.load_append(entity.name, rows, as_of, keys=entity.keys or None)
    return store.load_scd2(
        entity.name,
        stamp(rows, entity.tracked, as_of),
        entity.keys,
        as_of,
        null_safe=entity.null_safe,
    )


def audit(store: TableStore) -> DataFrame:
    """Row counts of all entities; those never loaded are reported as missing."""
    tables = {
        name: (store.read(name) if store.exists(name) else None, entity.strategy)
        for name, entity in ENTITIES.items()
    }
    return load_audit(store.spark, tables)
