"""Point-in-time (as-of) panel join: prices x the attribute version in effect.

Two plans, chosen by a size check:

* ``broadcast`` -- the history becomes validity intervals ``[from, to)``
  (the next version's time per key).  Closed intervals are exploded over
  the time buckets they cover; the current (open) version of each key is
  one row.  When both tables are *proven* small (rows and bytes, bounded
  from one aggregate over the history), they are broadcast and every price
  row finds its version by hash lookups on ``(key, bucket)`` / ``key`` plus
  a range check, in the scan stage: the price table is never shuffled.
  Intervals of one key are disjoint, so a row matches at most one.
* ``shuffle`` -- the skew-safe union + bucketed window of
  :func:`pitpanel.operators.sequence.asof_join`, for histories of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, row_bytes
from pitpanel.session import materialize
from pitpanel.operators.sequence import (DEFAULT_BUCKET_DAYS, asof_join, suggest_bucket_days,
                                        time_bucket, with_neighbor)


def _q(name: str):
    return F.col(f"`{name}`")


def _intervals(history: DataFrame, key: str, meta_ts: str, payload, tiebreak: Sequence[str],
               bucket_days: int) -> DataFrame:
    """``key, __from, __to, __m``: each version's validity interval
    ``[from, to)`` (``to`` null for the current version).  Versions sharing a
    timestamp get empty intervals except the greatest by ``tiebreak`` -- the
    one an as-of join picks -- and empty intervals are dropped."""
    h = history.where(_q(key).isNotNull() & _q(meta_ts).isNotNull())
    nxt = with_neighbor(h, key, meta_ts, [meta_ts], direction="next", tiebreak=list(tiebreak) or None,
                        bucket_days=bucket_days, out="__nx")
    iv = nxt.select(_q(key), _q(meta_ts).alias("__from"), F.col("__nx")[meta_ts].alias("__to"),
                    payload.alias("__m"))
    return iv.where(F.col("__to").isNull() | (F.col("__to") > F.col("__from")))


def interval_tables_fit(history: DataFrame, key: str, meta_ts: str, columns: Sequence[str],
                        bucket_days: int, max_rows: int, max_bytes: int) -> bool:
    """Prove the broadcast tables are small without building them.

    One key's closed intervals are disjoint and lie inside the history's
    time span, so exploded over buckets they have at most
    ``rows + keys * buckets_spanned`` rows; the open intervals are one row
    per key; no row is larger than the largest history row plus the
    fixed-width interval fields.  One aggregate over the history computes
    the bound.
    """
    h = history.select(key, meta_ts, *[c for c in columns if c not in (key, meta_ts)])
    b = h.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k"),
              F.min(time_bucket(meta_ts, bucket_days)).alias("b0"),
              F.max(time_bucket(meta_ts, bucket_days)).alias("b1"),
              F.max(row_bytes(h)).alias("w")).first()
    if b["n"] == 0:
        return True
    rows = b["n"] + b["k"] * (int(b["b1"]) - int(b["b0"]) + 1) + b["k"]
    return rows <= max_rows and rows * (int(b["w"]) + 32) <= max_bytes


def point_in_time(prices: DataFrame, history: DataFrame, columns: Sequence[str],
                  key: str = "sku", price_ts: str = "fetched_at", meta_ts: str = "observed_at",
                  observed_alias: str = "metadata_observed_at",
                  tiebreak: Sequence[str] = ("content_hash",),
                  bucket_days: int | str = DEFAULT_BUCKET_DAYS,
                  strategy: str = "auto", broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Every price row with the history row of its key having the greatest
    ``observed_at <= fetched_at`` (``ASOF LEFT JOIN`` semantics).

    Unmatched price rows are kept with null attributes; the matched
    version's time is returned as ``observed_alias``.  Ties on
    ``observed_at`` are broken by ``tiebreak`` (greatest wins).
    ``strategy``: ``"auto"`` (broadcast when proven small, else shuffle),
    ``"broadcast"`` or ``"shuffle"``.
    """
    wanted = {c: c for c in columns}
    wanted[meta_ts] = observed_alias
    tb = [c for c in tiebreak if c in history.columns]
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError("strategy must be 'auto', 'broadcast' or 'shuffle'")
    shuffle_width = bucket_days
    if bucket_days == "auto":
        # broadcast plan: few versions of a key per bucket keep the candidate
        # intervals per price row small
        bucket_days = suggest_bucket_days(history, key, meta_ts, rows_per_bucket=8)
    if strategy != "shuffle" and (strategy == "broadcast" or interval_tables_fit(
            history, key, meta_ts, [*columns, *tb], bucket_days, broadcast_rows, broadcast_bytes)):
        payload = F.struct(*[_q(src).alias(dst) for src, dst in wanted.items()])
        iv = _intervals(history, key, meta_ts, payload, tb, bucket_days).withColumnRenamed(key, "__key")
        iv = materialize(iv, "intervals")       # proven small; both tables below come from it
        b_from, b_to = time_bucket("__from", bucket_days), time_bucket("__to", bucket_days)
        closed = (iv.where(F.col("__to").isNotNull())
                  .select("__key", F.explode(F.sequence(b_from, b_to)).alias("__b"), "__from", "__to", "__m"))
        current = iv.where(F.col("__to").isNull()).select(
            F.col("__key").alias("__ckey"), F.col("__from").alias("__cfrom"), F.col("__m").alias("__cm"))
        p = prices.withColumn("__pb", time_bucket(price_ts, bucket_days))
        t = _q(price_ts)
        j = p.join(F.broadcast(closed), (p["__pb"] == closed["__b"]) & (p[f"`{key}`"] == closed["__key"])
                   & (t >= closed["__from"]) & (t < closed["__to"]), "left")
        j = j.join(F.broadcast(current), (j[f"`{key}`"] == current["__ckey"]) & (t >= current["__cfrom"]), "left")
        m = F.coalesce(F.col("__m"), F.col("__cm"))
        return j.select(*[p[f"`{c}`"] for c in prices.columns],
                        *[m[dst].alias(dst) for dst in wanted.values()])
    return asof_join(prices, history, key, price_ts, meta_ts, wanted,
                     tiebreak=tb or None, bucket_days=shuffle_width)
