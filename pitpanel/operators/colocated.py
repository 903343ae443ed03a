"""Panel joins and change detection over clustered tables, without an exchange.

Each operator answers as its namesake for plain tables does.  Rows of ordinary keys are worked on inside their
bucket; those of the few hot keys (see :mod:`pitpanel.sinks.clustered`) go
through the skew-safe operators, and both results are united.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.operators import scd
from pitpanel.operators.asof import point_in_time
from pitpanel.operators.sequence import DEFAULT_BUCKET_DAYS
from pitpanel.sinks.clustered import Clustered


def _q(name: str):
    return F.col(f"`{name}`")


def same_layout(a: Clustered, b: Clustered) -> None:
    if (a.key, a.buckets) != (b.key, b.buckets):
        raise ValueError(f"tables of different layouts: {a.buckets} buckets by {a.key}, {b.buckets} by {b.key}")


def panel(prices: Clustered, current: Clustered, columns: Sequence[str]) -> DataFrame:
    """Prices LEFT JOIN current attributes on the key (``loaders.load_panel``).

    ``current`` has one row a key, so its rows of hot keys are as few as these and are broadcast.
    """
    same_layout(prices, current)
    key = prices.key
    # merge: a bucket of the attributes need not fit a hash table
    cold = prices.cold.join(current.cold.select(key, *columns).hint("merge"), on=key, how="left")
    few = current.hot.where(_q(key).isNotNull()).select(key, *columns)
    hot = prices.hot.join(F.broadcast(few), on=key, how="left")
    order = [*[_q(c) for c in prices.cold.columns], *[_q(c) for c in columns]]
    return cold.select(*order).unionByName(hot.select(*order))


def panel_historical(prices: Clustered, history: Clustered, columns: Sequence[str], ts: str = "fetched_at", meta_ts: str = "observed_at",
                     observed_alias: str = "metadata_observed_at", tiebreak: Sequence[str] = ("content_hash",),
                     bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Prices with the attribute version in effect at each price time (``asof.point_in_time``)."""
    same_layout(prices, history)
    key, tiebreak = prices.key, [c for c in tiebreak if c in history.cold.columns]
    h = history.cold.where(_q(meta_ts).isNotNull())
    following = Window.partitionBy(_q(key)).orderBy(_q(meta_ts), *[_q(c) for c in tiebreak])
    payload = F.struct(*[_q(c) for c in columns], _q(meta_ts).alias(observed_alias)).alias("__m")
    held = h.select(_q(key).alias("__key"), _q(meta_ts).alias("__from"), F.lead(_q(meta_ts)).over(following).alias("__to"), payload)
    held = held.where(F.col("__to").isNull() | (F.col("__to") > F.col("__from")))     # of equal times the last one counts
    t = _q(ts)
    during = (_q(key) == F.col("__key")) & (t >= F.col("__from")) & (F.col("__to").isNull() | (t < F.col("__to")))
    cold = prices.cold.join(held.hint("merge"), during, "left")
    cold = cold.select(*[_q(c) for c in prices.cold.columns], *[F.col("__m")[c].alias(c) for c in [*columns, observed_alias]])
    hot = point_in_time(prices.hot, history.hot, columns, key=key, price_ts=ts, meta_ts=meta_ts, observed_alias=observed_alias,
                        tiebreak=tiebreak, bucket_days=bucket_days, strategy="shuffle")
    return cold.unionByName(hot)


def change_log(snapshots: Clustered, ts: str = "observed_at", hash_col: str = "content_hash", bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Rows whose content differs from the key's row before (``scd.change_log``)."""
    by_time = Window.partitionBy(_q(snapshots.key)).orderBy(_q(ts))
    before = snapshots.cold.withColumn("__first", F.row_number().over(by_time) == 1).withColumn("__old", F.lag(_q(hash_col)).over(by_time))
    cold = before.where(F.col("__first") | ~F.col("__old").eqNullSafe(_q(hash_col))).drop("__first", "__old")
    return cold.unionByName(scd.change_log(snapshots.hot, snapshots.key, ts, hash_col, bucket_days))


def build_index(log: Clustered, ts: str = "observed_at", hash_col: str = "content_hash") -> DataFrame:
    """Last hash, first and last time of each key (``scd.build_index``)."""
    return scd.build_index(log.cold, log.key, ts, hash_col).unionByName(scd.build_index(log.hot, log.key, ts, hash_col))
