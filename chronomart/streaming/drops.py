"""The same loads, run for the files that have arrived since the last run.

Loads are functions of the table and a batch, so Structured Streaming adds only the bookkeeping of
files. A batch that is repeated after a failure finds its rows loaded already and changes nothing.
Facts without a key carry the file they came in, in ``_file``: it is part of what they are, so a file delivered again adds
nothing, and equal facts of two files, or of one, are as many facts whichever batch brings them.
A table that every load replaces is given the whole folder, not the new files alone; families whose records
come per parent have no parent in a file and are refused.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.plans.entities import APPEND, CHILD, ENTITIES, OVERWRITE
from chronomart.plans.silver import run_load
from chronomart.plans.store import TableStore
from chronomart.sources.envelopes import ANY_ENVELOPE, read_envelopes, whole_records

#: The file a fact came in.
FILE = "_file"


def load_arrivals(
    spark: SparkSession,
    store: TableStore,
    entity_name: str,
    drop_folder: str,
    as_of: dt.date | str,
    checkpoint: str,
    multi_line: bool = True,
    glob: str = "*.json",
) -> None:
    """Load every envelope file not seen before under this ``checkpoint``, then return."""
    entity = ENTITIES[entity_name]
    if entity.arrives == CHILD:  # and so in no other way
        raise ValueError(f"{entity.name} arrives as {entity.arrives}, which files do not tell")

    def load(batch: DataFrame, _epoch: int) -> None:
        if entity.strategy == OVERWRITE:
            rows = read_envelopes(spark, drop_folder, entity.record, multi_line, glob, whole=True)
        elif entity.strategy == APPEND and not entity.keys:
            rows = whole_records(batch, entity.record, FILE)
        else:
            rows = whole_records(batch, entity.record)
        run_load(store, entity, rows, as_of)

    (
        spark.readStream.schema(ANY_ENVELOPE)
        .option("multiLine", str(multi_line).lower())
        .option("pathGlobFilter", glob)
        .json(drop_folder)
        .select("*", F.col("_metadata.file_path").alias(FILE))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
