"""Reshaping of raw records: nested fields to flat columns, column names, void columns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: "uri" at the start of a name, or of a part of it, marks a link column, which is
# called "url" from here on.
LINK_RULE = (r"(^|[._])uri(?=$|[A-Z_.])", r"\1url")
# Fixed value: path separators of flattened records.
DOT_RULE = (r"\.", "_")


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def _quoted(path: tuple[str, ...]) -> str:
    return ".".join(f"`{p}`" for p in path)


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs at any depth become ``a_b_c`` columns; arrays stay as they are."""
    leaves = list(_leaves(df.schema))
    names = [separator.join(path) for path in leaves]
    _reject_collisions(names)
    return df.select(
        *[F.col(_quoted(path)).alias(name) for path, name in zip(leaves, names, strict=True)]
    )


def _reject_collisions(names: Sequence[str]) -> None:
    # Spark resolves names without regard to case, so "URL" and "url" collide as well.
    repeated = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if repeated:
        raise ValueError(f"columns would share a name: {sorted(repeated)}")


def rename_by_rule(
    df: DataFrame, rules: Sequence[tuple[str, str]] = (LINK_RULE, DOT_RULE)
) -> DataFrame:
    """Rename all columns by regular expression, refusing a result with repeated names."""
    renamed = []
    for name in df.columns:
        new = name
        for pattern, replacement in rules:
            new = re.sub(pattern, replacement, new)
        renamed.append(new)
    _reject_collisions(renamed)
    return df.toDF(*renamed)


def drop_void(df: DataFrame) -> DataFrame:
    """Without the columns whose type is void, that is, which hold nothing but null."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)])


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add the columns of ``wanted`` (name to type) that ``df`` lacks, as null."""
    have = {c.lower() for c in df.columns}
    missing: dict[str, Column] = {
        name: F.lit(None).cast(dtype) for name, dtype in wanted.items() if name.lower() not in have
    }
    return df.withColumns(missing) if missing else df
