"""Row filters of the loaders: time range, key list, latest snapshot."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.operators.joins import maybe_broadcast

PARTITION_COLS = ("year", "month", "day")
MAX_IN_LIST = 10_000       # longer key lists are joined, not inlined


def _ts_literal(value, dtype: T.DataType):
    """A bound as a literal of the column's timestamp type.  Strings follow
    SQL casting, so ``'2026-04-22'`` means midnight of that day."""
    target = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    if isinstance(value, _dt.datetime) and value.tzinfo is not None and target == "timestamp_ntz":
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value).cast(target)


def _partition_key(df: DataFrame):
    if all(c in df.columns for c in PARTITION_COLS):
        return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return None


def _utc_day(ts: Column, dtype: T.DataType) -> Column:
    """``yyyymmdd`` of a bound as the folders are named: by UTC, whatever the session zone."""
    date = F.to_date(ts)
    if not isinstance(dtype, T.TimestampNTZType):
        date = F.date_add(F.lit(_dt.date(1970, 1, 1)), F.floor(F.unix_seconds(ts) / 86400).cast("int"))
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def time_range(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= ts <= end``; either bound may be None.

    On a ``year/month/day`` partitioned table the bounds are also applied
    to the partition columns so whole directories are pruned; rows without these (files
    outside such folders) are judged by ``ts`` alone.
    """
    dtype = df.schema[ts].dataType
    pkey = _partition_key(df)
    cond = F.lit(True)
    if start is not None:
        lo = _ts_literal(start, dtype)
        cond = cond & (F.col(ts) >= lo)
        if pkey is not None:
            cond = cond & (pkey.isNull() | (pkey >= _utc_day(lo, dtype)))
    if end is not None:
        hi = _ts_literal(end, dtype)
        cond = cond & (F.col(ts) <= hi)
        if pkey is not None:
            cond = cond & (pkey.isNull() | (pkey <= _utc_day(hi, dtype)))
    return df.where(cond)


def key_filter(df: DataFrame, key: str, keys: Sequence[str] | DataFrame | None,
               max_broadcast_rows: int | None = 2_000_000) -> DataFrame:
    """Restrict ``df`` to ``keys``.  An empty or missing list means *no
    filter*.  A Python list becomes an ``IN`` pushed to the scan; a
    DataFrame of keys becomes a left-semi join (broadcast only when a
    bounded count proves it small)."""
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).cast("string").alias(key)).distinct()
        return df.join(maybe_broadcast(k, max_broadcast_rows), on=key, how="left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    keys = [str(k) for k in keys]
    if not keys:
        return df
    if len(keys) > MAX_IN_LIST:
        # a very long literal list bloats every plan it appears in; as a
        # (provably small) frame it becomes a broadcast semi join instead
        spark = df.sparkSession
        frame = spark.createDataFrame([(k,) for k in sorted(set(keys))], f"`{key}` string")
        return df.join(maybe_broadcast(frame, max_broadcast_rows), on=key, how="left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return df.where(F.col(key).isin(keys))


def _newest(df: DataFrame, ts: str) -> Column:
    """The greatest ``ts`` as a literal, found by a small job.  Instants travel as
    microseconds, so the driver machine's zone plays no part."""
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(df.select(F.unix_micros(F.max(ts))).first()[0]).cast("long"))
    return F.lit(df.select(F.max(ts)).first()[0]).cast(dtype)


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the most recent run: ``ts = max(ts)`` over the whole table.

    The maximum is global, not per key: keys missing from the last run
    drop out.  It is resolved first (one small job) and applied as a
    literal, so the filter is pushed into the parquet scan (row groups
    whose ``ts`` range excludes it are skipped).  On a partitioned table the
    newest ``year/month/day`` partition is found from partition values
    alone, so both the maximum and the final scan read only that day.
    """
    pkey = _partition_key(df)
    if pkey is not None:
        last_day, outside = df.select(F.max(pkey), F.count_if(pkey.isNull())).first()
        if last_day is not None:
            newest_day = pkey == F.lit(last_day)
            df = df.where(pkey.isNull() | newest_day if outside else newest_day)
    return df.where(F.col(ts) == _newest(df, ts))


def previous_snapshot(df: DataFrame, ts: str, older_than: str = "1 day") -> DataFrame:
    """Rows of the last run more than ``older_than`` before the latest run."""
    bound = _newest(df, ts) - F.expr(f"INTERVAL {older_than}")
    return df.where(F.col(ts) == _newest(df.where(F.col(ts) < bound), ts))


def updated_since(recs: DataFrame, since, col: str = "itemUpdateDate") -> DataFrame:
    """Incremental filter: records whose ISO-text update date is after
    ``since`` (text is parsed, unparsable dates never match)."""
    from pitpanel.functions.timeparts import parse_iso
    return recs.where(parse_iso(col) > F.lit(since).cast("timestamp"))
