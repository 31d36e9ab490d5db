"""Types of records found while they are staged, and records with these types.

The records are read once, as variants. While they are written to the shared folder, an aggregate of the variants' own
schemas is observed on the same pass: integers widen to decimals and doubles, structs to the union of their
fields. Values of kinds with nothing in common (a number and a word, a struct and a list) become text, which holds
all of them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.session import materialise
from chronomart.sources.envelopes import ANY_ENVELOPE, _documents

#: A quoted name, which stays as it is, or the word for a struct.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)")


def declared(variant_schema: str) -> T.DataType:
    """The type that holds all values of a merged variant schema such as ``OBJECT<a: BIGINT, b: VARIANT>``."""
    ddl = _OBJECT.sub(lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], variant_schema)
    return _holding(T.DataType.fromDDL(ddl))


def _holding(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        fields = [T.StructField(f.name, _holding(f.dataType)) for f in dtype.fields]
        return T.StructType(fields) if fields else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_holding(dtype.elementType))
    return T.StringType() if isinstance(dtype, (T.VariantType, T.NullType)) else dtype


def staged_with_types(records: DataFrame, column: str) -> tuple[DataFrame, T.StructType]:
    """``records`` written once, and the type of the variants in ``column`` as found on the way.

    Elements that are no objects take no part; without any object the type has no fields.
    """
    objects = F.schema_of_variant(column).startswith("OBJECT")
    seen = Observation()
    observed = records.observe(seen, F.schema_of_variant_agg(F.when(objects, F.col(column))).alias("found"))
    staged = materialise(observed, "records")
    found = declared(seen.get["found"] or "VOID")
    return staged, found if isinstance(found, T.StructType) else T.StructType()


def typed(records: DataFrame, column: str, record: T.StructType, *keep: str) -> DataFrame:
    """The fields of the variants in ``column`` with the types of ``record``; text keeps objects and lists as JSON."""
    fields = [
        F.try_variant_get(column, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in record.fields
    ]
    return records.where(F.schema_of_variant(column).startswith("OBJECT")).select(*keep, *fields)


def read_inferred(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, glob: str = "*.json"
) -> DataFrame:
    """All records of all envelopes under ``path``, with the types found in them; the files are read once."""
    docs = _documents(spark, path, ANY_ENVELOPE, multi_line, glob)
    staged, record = staged_with_types(docs.select(F.explode("dados").alias("_r")), "_r")
    return typed(staged, "_r", record)
