"""Time helpers that stay inside whole-stage codegen and are zone-safe.

Truncation of ``timestamp_ntz`` values goes through ``DATE`` so it does not
depend on the session time zone; results are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE_UNITS = {"year", "quarter", "month", "week"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_to(c: str | Column, unit: str) -> Column:
    """Truncate a timestamp to ``unit``; returns ``timestamp_ntz``."""
    unit = unit.lower()
    col = _col(c)
    if unit in _DATE_UNITS:
        return F.trunc(col, unit).cast("timestamp_ntz")
    if unit == "day":
        return F.to_date(col).cast("timestamp_ntz")
    return F.date_trunc(unit, col.cast("timestamp_ntz")).cast("timestamp_ntz")


def partition_parts(ts: str | Column) -> list[Column]:
    """``year, month, day`` partition columns of a run timestamp."""
    col = _col(ts)
    return [F.year(col).alias("year"), F.month(col).alias("month"),
            F.dayofmonth(col).alias("day")]


def run_stamp(ts: str | Column) -> Column:
    """File-safe run identifier, e.g. ``2026-04-22T07-50-57Z``."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH-mm-ss'Z'")


def stamp_to_timestamp(stamp: str | Column) -> Column:
    """Run identifier ``yyyy-MM-ddTHH-mm-ssZ`` -> the UTC instant, independent
    of the session time zone."""
    c = _col(stamp)
    part = lambda a, n: F.substring(c, a, n).cast("int")
    return F.make_timestamp(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2),
                            part(18, 2).cast("decimal(16,6)"), F.lit("UTC"))


def parse_iso(text: str | Column) -> Column:
    """ISO-8601 text -> timestamp; accepts ``T`` or space, ``Z`` or an
    offset, fractional seconds; unparsable -> null."""
    t = F.regexp_replace(F.trim(_col(text)), "Z$", "+00:00")
    return F.coalesce(
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd")),
    )


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in (fractional) seconds, null if either is null.
    Zone-free for ``timestamp_ntz`` inputs."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1_000_000.0)
