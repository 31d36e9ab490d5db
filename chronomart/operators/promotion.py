"""Types that change between loads: columns widen where a wider type holds both, and what fits neither is kept aside.

A column known to both sides under two types gets a type that holds all values of both, if there is one: the larger
integer, a decimal with the digits of both, a double for numbers of which one is a double, a timestamp for dates and
timestamps. Otherwise the target's type stays, and a batch value that is none of that type becomes null and is kept
as text, under its column's name, in the map ``_rejected`` beside its row. No value fails a load.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of the values that did not fit, by column.
REJECTED = "_rejected"
#: Integers by width, with the decimal digits they need.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOST_DIGITS = 38


def _as_decimal(dtype: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    digits = _DIGITS.get(type(dtype))
    return None if digits is None else (digits, 0)


def wider(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """A type that holds all values of both; None if there is none. Exact numbers next to doubles become doubles."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if type(left) in _DIGITS and type(right) in _DIGITS:
        return left if _DIGITS[type(left)] >= _DIGITS[type(right)] else right
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        exact = _as_decimal(left), _as_decimal(right)
        if None in exact:
            return T.DoubleType()
        before, after = (max(n) for n in zip(*exact))
        return T.DecimalType(before + after, after) if before + after <= _MOST_DIGITS else T.DoubleType()
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(left, moments) and isinstance(right, moments):
        return left if isinstance(right, T.DateType) else right if isinstance(left, T.DateType) else T.TimestampType()
    return None


def _text(column: Column, dtype: T.DataType) -> Column:
    nested = isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    return F.to_json(column) if nested else column.cast("string")


def _fitted(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` as ``want``; null where a value is none of that type."""
    if have == want:
        return column
    if isinstance(want, T.StringType):
        return _text(column, have)
    atomic = not isinstance(want, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    if atomic and not isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        # A cast between kinds that Spark refuses altogether, such as a date and a number, goes by way of text.
        numbers = isinstance(have, (T.NumericType, T.StringType)) and isinstance(want, T.NumericType)
        moments = isinstance(have, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)) and isinstance(
            want, (T.DateType, T.TimestampType, T.TimestampNTZType)
        )
        value = column if numbers or moments or isinstance(have, T.NullType) else column.cast("string")
        fitted = value.try_cast(want)
        # A number or moment that loses something in the cast does not fit either.
        loses = (numbers or moments) and not isinstance(have, T.StringType) and wider(have, want) != want
        return F.when(fitted.try_cast(have) == column, fitted) if loses else fitted
    return F.lit(None).cast(want)


def promoted_types(
    target: T.StructType, batch: T.StructType, rules: Mapping[str, str] | None = None
) -> dict[str, T.DataType]:
    """The type of every column after the load, by its name in lower case. ``rules`` (column to type) come first."""
    chosen = {name.lower(): T.DataType.fromDDL(dtype) for name, dtype in (rules or {}).items()}
    arriving = {f.name.lower(): f.dataType for f in batch.fields}
    out = {name: chosen.get(name, dtype) for name, dtype in arriving.items()}
    for field in target.fields:
        name = field.name.lower()
        both = wider(field.dataType, arriving[name]) if name in arriving else field.dataType
        out[name] = chosen.get(name, both or field.dataType)
    return out


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """``df`` with the columns named in ``types`` (in lower case) in those types, and ``_rejected`` beside them.

    ``_rejected`` is null for a row whose values all fit; a column of that name in ``df`` is kept and added to.
    """
    values, lost = [], []
    for field in df.schema.fields:
        if field.name == REJECTED:
            continue
        column, want = F.col(f"`{field.name}`"), types.get(field.name.lower(), field.dataType)
        fitted = _fitted(column, field.dataType, want)
        values.append(fitted.alias(field.name))
        if field.dataType != want and not isinstance(want, T.StringType):
            missing = column.isNotNull() & fitted.isNull()
            lost.append(F.when(missing, F.struct(F.lit(field.name).alias("key"), _text(column, field.dataType).alias("value"))))
    none = F.lit(None).cast("map<string,string>")
    rejected = F.map_from_entries(F.array_compact(F.array(*lost))) if lost else none
    if REJECTED in df.columns:
        before = F.coalesce(F.col(REJECTED), F.create_map().cast("map<string,string>"))
        fresh = F.map_filter(before, lambda k, _: ~F.array_contains(F.map_keys(rejected), k)) if lost else before
        rejected = F.map_concat(fresh, rejected) if lost else fresh
    if lost or REJECTED in df.columns:
        rejected = F.when(F.size(rejected) > 0, rejected)
    return df.select(*values, rejected.alias(REJECTED))


def misfits(target: T.StructType, batch: T.StructType) -> dict[str, T.DataType]:
    """The target's types of columns that arrive under a type with which its files could no longer be read."""
    arriving = {f.name.lower(): f.dataType for f in batch.fields}
    return {
        f.name.lower(): f.dataType
        for f in target.fields
        if f.name.lower() in arriving and not _readable(f.dataType, wider(f.dataType, arriving[f.name.lower()]))
    }


def _readable(written: T.DataType, wanted: T.DataType | None) -> bool:
    """Whether Parquet values of one type can be read as the other."""
    if isinstance(written, T.LongType) and isinstance(wanted, T.DoubleType):
        return False
    if isinstance(written, T.DecimalType) and isinstance(wanted, T.DoubleType):
        return False
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return wanted is not None and (written == wanted or not isinstance(written, moments))


def append_widened(target: DataFrame, batch: DataFrame, rules: Mapping[str, str] | None = None) -> DataFrame:
    """Target plus every row of the batch, both in the types of :func:`promoted_types`.

    Columns known to one side only are null on the other. Rows of the target keep their values: their types only
    widen, unless a rule says otherwise, in which case what does not fit goes to ``_rejected`` as well.
    """
    types = promoted_types(target.schema, batch.schema, rules)
    return conform(target, types).unionByName(conform(batch, types), allowMissingColumns=True)
