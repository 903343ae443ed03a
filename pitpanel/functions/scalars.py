"""Small scalar helpers (casts, CSV-safe columns, display truncation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions.canonical import json_text


def to_double(c: str | Column) -> Column:
    """Lenient numeric cast of a text column (``'12.5'`` -> 12.5, junk -> null)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def flatten_nested(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Render array / map / struct columns as JSON text so CSV accepts them.

    The nested columns are chosen from the schema; everything else is left
    untouched, so the projection stays a single codegen stage.  Floating numbers inside them are
    printed as Java does (small ones as ``7.3E-4``), or, with ``decimals`` (up to 6), rounded to so many places
    and printed plainly, which reads alike everywhere.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)

    def shown(f: T.StructField) -> Column:
        if not isinstance(f.dataType, nested):
            return F.col(f"`{f.name}`")
        c = F.col(f"`{f.name}`")
        return json_text(c if decimals is None else c.cast(_plain(f.dataType, decimals))).alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _plain(t: T.DataType, decimals: int) -> T.DataType:
    """The type with its floating numbers as decimals."""
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return T.DecimalType(30, decimals)
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType, decimals), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _plain(t.valueType, decimals), t.valueContainsNull)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType, decimals), f.nullable) for f in t.fields])
    return t


def profile_text(c: str | Column, width: int = 80) -> Column:
    """Value as text cut to ``width`` characters with a ``...`` marker."""
    col = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(F.length(col) > width,
                  F.concat(F.substring(col, 1, width - 3), F.lit("..."))).otherwise(col)
