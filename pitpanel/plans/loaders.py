"""The analysis API: loaders over the panel tables, all lazy DataFrames.

Each function takes the tables as DataFrames (see
:class:`pitpanel.sources.store.PanelStore` for reading them from a data
root) plus the reference's filter arguments:

* ``start`` / ``end`` -- inclusive bounds on the run timestamp; a string
  ``'2026-04-22'`` means midnight, so later rows of that day are excluded;
* ``skus`` -- a key list (``None`` or ``[]`` = no filter) or a DataFrame of keys;
* ``sort`` -- the reference orders loads by ``(sku, time)``; a global sort
  costs a range shuffle, so pass ``sort=False`` when the consumer does not
  need ordered rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.asof import point_in_time
from pitpanel.operators.filters import key_filter, latest_snapshot, time_range
from pitpanel.operators.joins import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from pitpanel.operators.scd import as_of
from pitpanel.operators.sequence import DEFAULT_BUCKET_DAYS
from pitpanel.schemas import PANEL_METADATA_COLUMNS


def load_prices_latest(prices: DataFrame, skus=None, key: str = "sku",
                       ts: str = "fetched_at") -> DataFrame:
    """Rows of the most recent run (global maximum of ``ts``)."""
    return key_filter(latest_snapshot(prices, ts), key, skus)


def load_day_last_snapshot(prices: DataFrame, day, skus=None, key: str = "sku",
                           ts: str = "fetched_at") -> DataFrame:
    """Rows of the last run of calendar ``day`` (empty if the day has none).

    The day bounds prune the store's ``year/month/day`` partitions before
    the maximum is taken, so only that day's files are read."""
    import datetime as _dt
    d = _dt.date.fromisoformat(str(day)[:10])
    day_rows = time_range(prices, ts, f"{d} 00:00:00", f"{d} 23:59:59.999999")
    return key_filter(latest_snapshot(day_rows, ts), key, skus)


def load_prices(prices: DataFrame, start=None, end=None, skus=None, key: str = "sku",
                ts: str = "fetched_at", sort: bool = True) -> DataFrame:
    """Price rows with ``ts`` in ``[start, end]``, optionally for ``skus``."""
    out = key_filter(time_range(prices, ts, start, end), key, skus)
    return out.orderBy(key, ts) if sort else out


def load_metadata_current(current: DataFrame, skus=None, key: str = "sku") -> DataFrame:
    """The current attribute table, optionally restricted to ``skus``."""
    return key_filter(current, key, skus)


def load_metadata_at(history: DataFrame, as_of_ts, skus=None, restrict_to=None,
                     key: str = "sku", ts: str = "observed_at",
                     tiebreak: Sequence[str] = ("content_hash",)) -> DataFrame:
    """Attributes of every key as of ``as_of_ts`` (greatest ``ts <= as_of``).

    ``restrict_to`` (e.g. the current table) keeps only keys present in
    it -- the reference's ``restrict_to_active=True``.
    """
    h = key_filter(history, key, skus)
    if restrict_to is not None:
        h = h.join(restrict_to.select(key).distinct(), on=key, how="left_semi")
    return as_of(h, as_of_ts, key=key, ts=ts, tiebreak=tiebreak)


def load_panel(prices: DataFrame, current: DataFrame, start=None, end=None, skus=None,
               columns: Sequence[str] = PANEL_METADATA_COLUMNS, key: str = "sku",
               ts: str = "fetched_at", sort: bool = True,
               broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Prices LEFT JOIN current attributes on the key.

    The attribute side is catalog-sized; it is broadcast only when a bounded
    count proves it has at most ``broadcast_rows`` rows, otherwise the join
    stays a sort-merge join (AQE splits skewed partitions).
    """
    p = key_filter(time_range(prices, ts, start, end), key, skus)
    m = current.select(key, *columns)
    out = p.join(maybe_broadcast(m, broadcast_rows), on=key, how="left")
    out = out.select(*[F.col(f"`{c}`") for c in p.columns], *columns)
    return out.orderBy(key, ts) if sort else out


def load_panel_historical(prices: DataFrame, history: DataFrame, start=None, end=None,
                          skus=None, columns: Sequence[str] = PANEL_METADATA_COLUMNS,
                          key: str = "sku", ts: str = "fetched_at", meta_ts: str = "observed_at",
                          sort: bool = True, bucket_days: int = DEFAULT_BUCKET_DAYS,
                          strategy: str = "auto") -> DataFrame:
    """Prices joined with the attribute version in effect at each price time.

    Filters are applied to the price side before the join; the history gets
    only the upper time bound (versions before ``start`` are still needed).
    ``strategy`` picks the join plan (see :mod:`pitpanel.operators.asof`):
    a broadcast of validity intervals when they are proven small, else the
    skew-safe shuffle plan.
    """
    p = key_filter(time_range(prices, ts, start, end), key, skus)
    h = key_filter(time_range(history, meta_ts, None, end), key, skus)
    out = point_in_time(p, h, columns, key=key, price_ts=ts, meta_ts=meta_ts,
                        bucket_days=bucket_days, strategy=strategy)
    return out.orderBy(key, ts) if sort else out
