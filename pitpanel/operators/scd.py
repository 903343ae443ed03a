"""Slowly-changing-dimension operators over a content-hashed attribute log.

* :func:`dedupe_by_key`      -- one row per key inside a run (page shifts)
* :func:`diff`               -- one ingestion step: current vs hash index
* :func:`change_log`         -- backfill: changed rows over many snapshots
* :func:`build_index`        -- hash index from a log or snapshots
* :func:`validity_intervals` -- ``[valid_from, valid_to)`` per version
* :func:`as_of`              -- state of every key at one moment
* :func:`as_of_many`         -- state at several moments in one pass
* :func:`as_of_grid`         -- state at each moment of a long regular grid
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.canonical import content_hash
from pitpanel.operators.sequence import DEFAULT_BUCKET_DAYS, with_neighbor


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def with_content_hash(df: DataFrame, columns: Sequence[str], out: str = "content_hash") -> DataFrame:
    """Add the SHA-256 content hash of ``columns`` (nulls included)."""
    return df.withColumn(out, content_hash(columns))


def _top1(df: DataFrame, key: str, order_desc: Sequence[str]) -> DataFrame:
    """One row per ``key``: the greatest by ``order_desc``.

    ``row_number() = 1`` plans as a WindowGroupLimit that first keeps the
    top row of every key *inside each map task*, so a key with a long
    history is reduced before the shuffle and never gathered in one task.
    """
    w = Window.partitionBy(_q(key)).orderBy(*[_q(c).desc() for c in order_desc])
    return (df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
            .drop("__rn"))


def dedupe_by_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Keep one row per ``key``: the one with the greatest ``order_by``
    (duplicates are collapsed map-side, see :func:`_top1`)."""
    return _top1(df, key, order_by)


def dedupe_steps(df: DataFrame, key: str, step: str, order_by: Sequence[str]) -> DataFrame:
    """One row per ``key`` and ``step`` (never null): the one with the greatest ``order_by``.

    One pass over each key's rows in order of ``step``, which a window by ``key`` and ``step`` after it
    shares (its exchange and its sort): for keys with a bounded number of rows."""
    w = Window.partitionBy(_q(key)).orderBy(_q(step), *[_q(c).desc() for c in order_by])
    return df.withColumn("__step", F.lag(_q(step)).over(w)).where(~_q("__step").eqNullSafe(_q(step))).drop("__step")


def diff(current: DataFrame, index: DataFrame, key: str = "sku",
         hash_col: str = "content_hash", ts: str = "observed_at"):
    """One change-detection step.

    Returns ``(changed_rows, updated_index)``:

    * ``changed_rows`` -- full rows of ``current`` whose key is new or whose
      hash differs from the index (``NOT hash <=> old_hash``);
    * ``updated_index`` -- ``key, hash, first_seen, last_seen``: keys in
      ``current`` take its hash and ``last_seen = ts`` and keep their
      ``first_seen``; keys only in the index are carried forward unchanged.

    ``current`` must hold one row per key (see :func:`dedupe_by_key`).  One
    full outer join on the key serves both outputs; keys are unique on both
    sides, so the join has no fan-out and no hot key.
    """
    idx = index.select(_q(key), _q(hash_col).alias("__old_hash"),
                       F.col("first_seen").alias("__first_seen"),
                       F.col("last_seen").alias("__last_seen"))
    cur = current.withColumn("__present", F.lit(True))
    j = cur.join(idx, on=key, how="full_outer")
    present = _q("__present").isNotNull()
    changed = (j.where(present & ~_q(hash_col).eqNullSafe(_q("__old_hash")))
               .select(*[_q(c) for c in current.columns]))
    updated = j.select(
        _q(key),
        F.when(present, _q(hash_col)).otherwise(_q("__old_hash")).alias(hash_col),
        F.when(present, F.coalesce(_q("__first_seen"), _q(ts)))
         .otherwise(_q("__first_seen")).alias("first_seen"),
        F.when(present, _q(ts)).otherwise(_q("__last_seen")).alias("last_seen"),
    )
    return changed, updated


def change_log(snapshots: DataFrame, key: str = "sku", ts: str = "observed_at",
               hash_col: str = "content_hash", bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Backfill form of :func:`diff` over many full snapshots at once.

    A snapshot row is a change when its key had no earlier snapshot or the
    earlier snapshot's hash differs.  Equal to folding :func:`diff` run by
    run: a key absent for a while and back with the same content is not a
    change.  ``snapshots`` must hold one row per ``(key, ts)``.
    """
    with_prev = with_neighbor(snapshots, key, ts, [hash_col], direction="prev",
                              bucket_days=bucket_days, out="__prev")
    return (with_prev.where(_q("__prev").isNull()
                            | ~_q("__prev")[hash_col].eqNullSafe(_q(hash_col)))
            .drop("__prev"))


def build_index(log: DataFrame, key: str = "sku", ts: str = "observed_at",
                hash_col: str = "content_hash") -> DataFrame:
    """``key, last hash, first_seen = min(ts), last_seen = max(ts)``.

    Built from a change log it gives first/last *change*; from snapshots,
    first/last *sighting* -- the index a run-by-run fold would leave.  Rows
    sharing the last timestamp are ordered by hash, so the result is
    deterministic.
    """
    return (log.groupBy(_q(key))
            .agg(F.max_by(_q(hash_col), F.struct(_q(ts), _q(hash_col))).alias(hash_col),
                 F.min(_q(ts)).alias("first_seen"),
                 F.max(_q(ts)).alias("last_seen")))


def validity_intervals(history: DataFrame, key: str = "sku", ts: str = "observed_at",
                       tiebreak: Sequence[str] | None = None, bucket_days: int = DEFAULT_BUCKET_DAYS,
                       valid_to: str = "valid_to") -> DataFrame:
    """Add ``valid_to`` = the next version's ``ts`` (null for the open
    version), so each row covers ``[ts, valid_to)``."""
    nxt = with_neighbor(history, key, ts, [ts], direction="next", tiebreak=tiebreak,
                        bucket_days=bucket_days, out="__next")
    return nxt.withColumn(valid_to, _q("__next")[ts]).drop("__next")


def as_of(history: DataFrame, when, key: str = "sku", ts: str = "observed_at",
          tiebreak: Sequence[str] = ("content_hash",)) -> DataFrame:
    """For each key, its row with the greatest ``ts <= when``.

    Keys never observed by ``when`` are omitted.  The ranked filter is
    reduced map-side (see :func:`_top1`), so a key with a long history never
    lands whole in one task.
    """
    tiebreak = [c for c in tiebreak if c in history.columns]
    bound = F.lit(when).cast(history.schema[ts].dataType)
    return _top1(history.where(_q(ts) <= bound), key, [ts, *tiebreak])


def as_of_many(history: DataFrame, moments: Sequence, columns: Sequence[str],
               key: str = "sku", ts: str = "observed_at",
               tiebreak: Sequence[str] = ("content_hash",), out_ts: str = "as_of") -> DataFrame:
    """State of every key at each of several ``moments`` in one aggregation.

    One conditional ``max_by`` per moment (no cross join with the moment
    list), then the per-moment structs are unpivoted.  Rows:
    ``key, as_of, ts, columns...`` for moments where the key existed.
    """
    tiebreak = [c for c in tiebreak if c in history.columns]
    dtype = history.schema[ts].dataType
    payload = F.struct(_q(ts), *[_q(c) for c in columns])
    order = F.struct(_q(ts), *[_q(c) for c in tiebreak])
    aggs = []
    for i, m in enumerate(moments):
        inside = _q(ts) <= F.lit(m).cast(dtype)
        aggs.append(F.max_by(F.when(inside, payload), F.when(inside, order)).alias(f"__s{i}"))
    wide = history.groupBy(_q(key)).agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(m).cast(dtype).alias(out_ts), F.col(f"__s{i}").alias("v"))
                      for i, m in enumerate(moments)])
    long = wide.select(_q(key), F.inline(pairs)).where(F.col("v").isNotNull())
    return long.select(_q(key), _q(out_ts), *[F.col("v")[c].alias(c) for c in [ts, *columns]])


def as_of_grid(history: DataFrame, start, steps: int, columns: Sequence[str], days: int = 1, key: str = "sku",
               ts: str = "observed_at", tiebreak: Sequence[str] | None = None, bucket_days: int = DEFAULT_BUCKET_DAYS,
               out_ts: str = "as_of", count: str | None = None) -> DataFrame:
    """State of every key at each of ``steps`` moments, ``days`` days apart from ``start`` on.

    For grids too long for :func:`as_of_many`: each version is exploded over the moments of its validity
    interval, so the plan does not grow with the grid and the work is that of the result
    (rows ``key, as_of, ts, columns...``).  Of versions with one ``ts`` the greatest by ``tiebreak`` counts.

    With ``count`` the rows are ``as_of, columns..., count``: how many keys are in each state at each moment.  Intervals
    that cover the same moments in the same state are then counted before they are exploded, so the work is one
    group-by of the versions, and the exploded rows are bounded by pairs of moments, not by keys.
    """
    dtype = history.schema[ts].dataType
    zero = F.lit(start).cast(dtype)
    micros = days * 86_400_000_000

    def cell(c: Column) -> Column:
        """Number of the first moment that is not before ``c``."""
        return F.ceil(F.timestamp_diff("MICROSECOND", zero, c) / F.lit(float(micros))).cast("long")

    held = validity_intervals(history, key, ts, tiebreak=tiebreak, bucket_days=bucket_days, valid_to="__until")
    first = F.greatest(cell(_q(ts)), F.lit(0))
    last = F.least(F.coalesce(cell(F.col("__until")), F.lit(steps)), F.lit(steps)) - 1
    cells = held.withColumn("__first", first).withColumn("__last", last).where("__first <= __last")
    moment = F.timestamp_add("DAY", (F.col("__i") * days).cast("int"), zero)
    if count is not None:
        same = cells.groupBy("__first", "__last", *[_q(c) for c in columns]).agg(F.count(F.lit(1)).alias("__n"))
        spread = same.select(*[_q(c) for c in columns], "__n", F.explode(F.sequence("__first", "__last")).alias("__i"))
        return (spread.groupBy("__i", *[_q(c) for c in columns]).agg(F.sum("__n").alias(count))
                .select(moment.alias(out_ts), *[_q(c) for c in columns], _q(count)))
    long = cells.select(_q(key), _q(ts), *[_q(c) for c in columns], F.explode(F.sequence("__first", "__last")).alias("__i"))
    return long.select(_q(key), moment.alias(out_ts), _q(ts), *[_q(c) for c in columns])


def drifted_keys(history: DataFrame, moments: Sequence, columns: Sequence[str],
                 key: str = "sku", ts: str = "observed_at",
                 tiebreak: Sequence[str] = ("content_hash",)) -> DataFrame:
    """Keys whose ``columns`` differ between the states as of ``moments``.

    Rows ``key, n_states, first_as_of, last_as_of``: the number of distinct
    attribute states seen across the moments (> 1) and the first and last
    moment at which the key existed.  Built on :func:`as_of_many`, then one
    grouped aggregation per key.
    """
    states = as_of_many(history, moments, columns, key=key, ts=ts, tiebreak=tiebreak)
    g = states.groupBy(_q(key)).agg(
        F.count_distinct(F.struct(*[_q(c) for c in columns])).alias("n_states"),
        F.min("as_of").alias("first_as_of"), F.max("as_of").alias("last_as_of"))
    return g.where(F.col("n_states") > 1)
