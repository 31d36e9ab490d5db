"""JSON envelopes ``{"dados": [record, ...], "links": [{"rel": ...}, ...]}``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: Column that holds, as JSON, what a record's declared type does not.
EXTRA = "_extra"
LINKS = T.ArrayType(
    T.StructType([T.StructField("rel", T.StringType()), T.StructField("href", T.StringType())])
)


def envelope_schema(record: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("dados", T.ArrayType(record)), T.StructField("links", LINKS)]
    )


#: Envelopes with records of any shape.
ANY_ENVELOPE = T.StructType(
    [T.StructField("dados", T.ArrayType(T.VariantType())), T.StructField("links", LINKS)]
)


def _documents(
    spark: SparkSession, path: str | list[str], envelope: T.StructType, multi_line: bool, glob: str
) -> DataFrame:
    return (
        spark.read.schema(T.StructType([*envelope.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .json(path)
    )


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def whole_records(docs: DataFrame, record: T.StructType, *keep: str) -> DataFrame:
    """One row per record of ``dados``, an array of variants: the declared fields with their types, and
    whatever else a record holds as JSON in ``_extra``, null if nothing.

    A nested declared field goes to ``_extra`` as it came, too, since its type may not name all that is
    in it. A value that does not fit its declared type is null and stays in ``_extra`` as well.
    """
    rows = docs.select(*keep, F.explode("dados").alias("_r"))
    typed = {f.name: F.try_variant_get("_r", f"$['{f.name}']", f.dataType.simpleString()) for f in record.fields}
    plain = [f.name for f in record.fields if not _is_nested(f.dataType)]
    rows = rows.select(*keep, "_r", *[c.alias(name) for name, c in typed.items()])
    fields = F.col("_r").cast("map<string,variant>")

    def rest(name: Column, value: Column) -> Column:
        # Field by field: a list of the told names would be made again for every entry of the map.
        told = reduce(Column.__or__, [(name == n) & F.col(f"`{n}`").isNotNull() for n in plain], F.lit(False))
        return ~told & ~F.is_variant_null(value)

    rows = rows.withColumn("_rest", F.map_filter(fields, rest))
    extra = F.when(F.size("_rest") > 0, F.to_json("_rest"))
    return rows.select(*keep, *[F.col(f"`{f.name}`") for f in record.fields], extra.alias(EXTRA))


def read_envelopes(
    spark: SparkSession,
    path: str | list[str],
    record: T.StructType,
    multi_line: bool = True,
    glob: str = "*.json",
    whole: bool = False,
) -> DataFrame:
    """All records of all envelopes under ``path``; with ``whole``, undeclared fields are kept in ``_extra``.

    One file per document needs ``multi_line``; files holding one envelope per line are
    read without it and can then be split between tasks. A document without ``dados``,
    or one that is no JSON, adds no rows; see :func:`unreadable_envelopes`.
    """
    if whole:
        return whole_records(_documents(spark, path, ANY_ENVELOPE, multi_line, glob), record)
    return _documents(spark, path, envelope_schema(record), multi_line, glob).select(F.inline("dados"))


def unreadable_envelopes(
    spark: SparkSession,
    path: str | list[str],
    record: T.StructType,
    multi_line: bool = True,
    glob: str = "*.json",
) -> DataFrame:
    """The documents :func:`read_envelopes` skipped: file and a reason."""
    docs = _documents(spark, path, envelope_schema(record), multi_line, glob)
    return docs.select(
        F.input_file_name().alias("file"),
        F.when(F.col(CORRUPT).isNotNull(), F.lit("not readable as an envelope"))
        .when(F.col("dados").isNull(), F.lit("no dados"))
        .alias("reason"),
    ).where("reason IS NOT NULL")


def parse_envelopes(df: DataFrame, text: str, record: T.StructType) -> DataFrame:
    """Envelopes held as JSON text in a column, with ``dados`` and ``links`` parsed out."""
    parsed = F.from_json(F.col(text), envelope_schema(record))
    return df.withColumn("_envelope", parsed).select(
        *[c for c in df.columns if c != text],
        F.col("_envelope.dados").alias("dados"),
        F.col("_envelope.links").alias("links"),
    )


def infer_record_schema(
    spark: SparkSession, path: str, multi_line: bool = True, sampling_ratio: float = 1.0
) -> T.StructType:
    """Record type found in the files. Prefer a declared schema: this reads them once more."""
    found = (
        spark.read.option("multiLine", str(multi_line).lower())
        .option("samplingRatio", sampling_ratio)
        .json(path)
        .schema
    )
    return found["dados"].dataType.elementType


def year_window(as_of_year: int, years: int = 8) -> list[int]:
    """The ``years`` calendar years that end with ``as_of_year``."""
    return list(range(as_of_year - years + 1, as_of_year + 1))


def read_year_window(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    as_of_year: int,
    years: int = 8,
    multi_line: bool = True,
    whole: bool = False,
) -> DataFrame:
    """Envelopes of files named ``<anything>-<year>.json`` for the years in the window.

    The years are part of the listing pattern, so other files are never opened and a
    missing year is no error.
    """
    wanted = ",".join(str(y) for y in year_window(as_of_year, years))
    return read_envelopes(spark, path, record, multi_line, f"*-{{{wanted}}}.json", whole)


def read_year_partitions(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    as_of_year: int,
    years: int = 8,
    multi_line: bool = False,
    glob: str = "*.json",
) -> DataFrame:
    """The same window over folders ``year=<year>/``, pruned by partition."""
    docs = _documents(spark, path, envelope_schema(record), multi_line, glob)
    return docs.where(F.col("year").isin(year_window(as_of_year, years))).select("year", F.inline("dados"))
