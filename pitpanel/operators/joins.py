"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when one bounded job proves it has at most this
# many rows *and* this many bytes of column data; beyond either bound the join
# stays a shuffle join (AQE may still turn it into a broadcast once the real
# shuffle size is measured).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_VARIABLE = (T.StringType, T.BinaryType)
_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: exact for strings and binaries, JSON text
    length for nested values, the type's fixed width otherwise."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _VARIABLE):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, _NESTED):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED.get(type(f.dataType), 8)))
    total = parts[0] if parts else F.lit(0)
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def provably_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True iff ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Each task counts its rows and bytes; only those sums are shuffled.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(row_bytes(df)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven below the bounds, else ``df``.

    ``max_rows=None`` skips the check and leaves the choice to AQE.
    """
    if max_rows is None:
        return df
    return F.broadcast(df) if provably_small(df, max_rows, max_bytes) else df


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls of the ``on`` columns match; keeps the left side's."""
    names = {c: f"__on_{i}" for i, c in enumerate(on)}
    other = right.withColumnsRenamed(names)
    cond = F.lit(True)
    for c, n in names.items():
        cond = cond & left[c].eqNullSafe(other[n])
    return left.join(other, cond, how).drop(*names.values())
