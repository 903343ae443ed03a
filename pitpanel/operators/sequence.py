"""Skew-safe keyed sequence operators.

Three questions recur across the panel: *which version of a key was in
effect at time t* (as-of lookup), *what was the key's previous row*
(change detection, run streaks) and *what is its next row* (validity
intervals).  The textbook answer is one window partitioned by the key,
but a single hot key (one SKU, one source, or a constant key such as "all
runs") would then be processed by one task.

Here the work is partitioned by ``(key, time bucket)`` instead, where a
bucket is ``floor(days since epoch / bucket_days)``.  Inside a bucket the
window does the work; the only thing that crosses a bucket boundary is one
value per ``(key, bucket)`` -- the last (or first) row of that bucket --
which a small summary window over buckets carries to the next bucket that
needs it.  Per-task work is therefore bounded by the rows of one key in one
bucket, and the summary by the number of buckets a key spans (calendar
bound, not data bound).  Results are exact: buckets are ordered like
timestamps, so the carried value is exactly the row a global window would
have seen.

The per-bucket edge rows come from a partially aggregated ``max_by`` /
``min_by`` rather than from a second window: the data is shuffled once (for
the in-bucket window); the summary shuffle carries one row per
``(key, bucket)`` and map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bucket width: bounds the rows of one key that one task orders (about 120
# at four runs a day) and the buckets a key's summary spans (about 120 over
# ten years).  Coarser data (monthly runs) can use wider buckets; pass
# bucket_days="auto" to derive the width from the data's density.
DEFAULT_BUCKET_DAYS = 30

_B = "__pp_bucket"
_T = "__pp_t"
_S = "__pp_side"
_O = "__pp_ord"
_M = "__pp_m"
_TB = "__pp_tb"
_V = "__pp_v"
_IN = "__pp_in"
_C = "__pp_carry"
_BL = "__pp_bucket_edge"


def time_bucket(ts: str | Column, bucket_days: int) -> Column:
    """Integer bucket of a timestamp: seconds since epoch // ``bucket_days`` days of them.

    Counted in seconds, not in dates of the session zone, which a zone that steps back
    across midnight puts out of order."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(col) / F.lit(86400 * int(bucket_days))).cast("long")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def suggest_bucket_days(df: DataFrame, keys: str | Sequence[str], ts: str,
                        rows_per_bucket: int = 128, max_days: int = 3660) -> int:
    """A bucket width giving about ``rows_per_bucket`` rows of a key per bucket.

    One aggregate: row count, an approximate distinct key count (HyperLogLog,
    partial per task) and the time span in days; the density of an average
    key decides the width.  The width only tunes task sizes -- results are
    exact for any width.
    """
    keys = _as_list(keys)
    key = F.struct(*[_q(k) for k in keys]) if len(keys) > 1 else _q(keys[0])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(key).alias("k"),
               F.min(F.unix_date(F.to_date(_q(ts)))).alias("d0"),
               F.max(F.unix_date(F.to_date(_q(ts)))).alias("d1")).first()
    if not r["n"] or not r["k"] or r["d0"] is None:
        return DEFAULT_BUCKET_DAYS
    per_key_per_day = r["n"] / r["k"] / (r["d1"] - r["d0"] + 1)
    return int(min(max(round(rows_per_bucket / max(per_key_per_day, 1e-9)), 1), max_days))


def _width(df: DataFrame, keys, ts: str, bucket_days) -> int:
    return suggest_bucket_days(df, keys, ts) if bucket_days == "auto" else int(bucket_days)


def _as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def asof_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
              left_ts: str, right_ts: str,
              right_cols: Sequence[str] | dict[str, str],
              *, strict: bool = False, tiebreak: str | Sequence[str] | None = None,
              bucket_days: int | str = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Left as-of join.

    Every ``left`` row is kept once and gets the ``right`` row of the same
    ``keys`` with the greatest ``right_ts <= left_ts`` (``<`` if ``strict``);
    unmatched rows get nulls.  ``right_cols`` names the right columns to
    attach (a dict renames them, e.g. ``{"observed_at": "metadata_observed_at"}``).
    Right rows sharing a timestamp are ordered by ``tiebreak`` (the greatest
    wins), so the result is deterministic.

    Attributes travel as one struct, so a null attribute of the matched
    version is never back-filled from an older version.
    """
    keys = _as_list(keys)
    tiebreak = _as_list(tiebreak)
    mapping = dict(right_cols) if isinstance(right_cols, dict) else {c: c for c in right_cols}
    payload = F.struct(*[_q(src).alias(dst) for src, dst in mapping.items()])
    tb = F.struct(*[_q(c) for c in tiebreak]) if tiebreak else F.lit(None).cast("int")

    # right side before left at equal times (<=); after it for strict (<)
    right_ord, left_ord = (1, 0) if strict else (0, 1)
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & _q(k).isNotNull()
    r = (right.where(key_ok & _q(right_ts).isNotNull())
         .select(*[_q(k) for k in keys], _q(right_ts).alias(_T),
                 F.lit(0).alias(_S), F.lit(right_ord).alias(_O),
                 tb.alias(_TB), payload.alias(_M)))
    m_type = r.schema[_M].dataType
    l = left.select(*[_q(c) for c in left.columns], _q(left_ts).alias(_T),
                    F.lit(1).alias(_S), F.lit(left_ord).alias(_O),
                    F.lit(None).cast(r.schema[_TB].dataType).alias(_TB),
                    F.lit(None).cast(m_type).alias(_M))
    u = l.unionByName(r, allowMissingColumns=True)
    bucket_days = _width(u, keys, _T, bucket_days)
    u = u.withColumn(_B, time_bucket(_T, bucket_days))

    # inside (key, bucket): running "last right row so far"
    ordered = (Window.partitionBy(*[_q(k) for k in keys], _q(_B))
               .orderBy(_q(_T).asc_nulls_first(), _q(_O), _q(_TB).asc_nulls_first()))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    win = u.withColumn(_IN, F.last(_q(_M), ignorenulls=True).over(running))

    # per (key, bucket): the last right row (a partially aggregated maximum of the right rows alone), and
    # whether left rows live there (distinct keys and buckets: nothing of the left rows is sorted); then,
    # per key, carry the last right row of strictly earlier buckets forward
    bucket = time_bucket(_T, bucket_days).alias(_B)
    names = [_q(k) for k in keys]
    edges = (r.select("*", bucket).groupBy(*names, _q(_B)).agg(F.max_by(_q(_M), F.struct(_q(_T), _q(_TB))).alias(_BL))
             .select("*", F.lit(1).alias(_S)))
    asked = l.where(key_ok).select(*names, bucket).distinct().select("*", F.lit(0).alias(_S))
    w_b = Window.partitionBy(*names).orderBy(_q(_B), _q(_S)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = (edges.unionByName(asked, allowMissingColumns=True).withColumn(_C, F.last(_q(_BL), ignorenulls=True).over(w_b))
             .where((_q(_S) == 0) & _q(_C).isNotNull()).select(*names, _q(_B), _q(_C)))

    # rows without an in-bucket match take the carried version
    out = (win.where(_q(_S) == 1).join(carry, on=[*keys, _B], how="left")
           .withColumn(_M, F.coalesce(_q(_IN), _q(_C))))
    return out.select(*[_q(c) for c in left.columns],
                      *[_q(_M)[dst].alias(dst) for dst in mapping.values()])


def with_neighbor(df: DataFrame, keys: str | Sequence[str], ts: str,
                  cols: Sequence[str], *, direction: str = "prev",
                  tiebreak: str | Sequence[str] | None = None,
                  bucket_days: int | str = DEFAULT_BUCKET_DAYS, out: str = "neighbor") -> DataFrame:
    """Add struct column ``out`` holding ``cols`` of the previous
    (``direction="prev"``) or next (``"next"``) row of the same key in
    ``(ts, tiebreak)`` order; null when there is none.  A row whose key is
    null has no neighbour.

    The caller supplies a total order per key (dedupe first); ties are
    otherwise resolved arbitrarily, as with any ``lag``/``lead``.
    """
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    keys = _as_list(keys)
    order = [_q(ts), *[_q(c) for c in _as_list(tiebreak)]]
    bucket_days = _width(df, keys, ts, bucket_days)
    d = (df.withColumn(_V, F.struct(*[_q(c) for c in cols]))
         .withColumn(_B, time_bucket(ts, bucket_days)))
    ordered = Window.partitionBy(*[_q(k) for k in keys], _q(_B)).orderBy(*order)
    shift = F.lag if direction == "prev" else F.lead
    win = d.withColumn(_IN, shift(_q(_V), 1).over(ordered))
    # each bucket's edge row by a partially aggregated max_by / min_by: only
    # one row per (key, bucket) and map task crosses the shuffle
    pick = F.max_by if direction == "prev" else F.min_by
    summary = (d.groupBy(*[_q(k) for k in keys], _q(_B))
               .agg(pick(_q(_V), F.struct(*order)).alias(_BL)))
    w_b = Window.partitionBy(*[_q(k) for k in keys]).orderBy(_q(_B))
    carry = (summary.withColumn(_C, shift(_q(_BL), 1).over(w_b))
             .where(_q(_C).isNotNull())
             .select(*[_q(k) for k in keys], _q(_B), _q(_C)))
    res = win.join(carry, on=[*keys, _B], how="left")
    # only the first (prev) / last (next) row of a bucket may take the carry
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & _q(k).isNotNull()
    return (res.withColumn(out, F.when(key_ok, F.coalesce(_q(_IN), _q(_C))))
            .drop(_V, _B, _IN, _C))
