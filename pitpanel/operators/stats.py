"""Group statistics, top-k and histograms used by the panel analyses."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.joins import join_null_safe, provably_small


def top_k(df: DataFrame, by: str, k: int, tiebreak: Sequence[str] = ("sku",),
          drop_nulls: bool = True) -> DataFrame:
    """The ``k`` rows with the greatest ``by`` (ties by ``tiebreak`` asc).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task
    keeps its own top ``k`` and only ``k x tasks`` rows meet at the end.
    """
    d = df.where(F.col(by).isNotNull()) if drop_nulls else df
    return d.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tiebreak]).limit(k)


def ranked(df: DataFrame, by: str, k: int, tiebreak: Sequence[str] = ("sku",),
           rank_col: str = "rank") -> DataFrame:
    """:func:`top_k` with a 1-based rank column (the window runs over k rows)."""
    from pyspark.sql import Window
    top = top_k(df, by, k, tiebreak)
    w = Window.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tiebreak])
    return top.withColumn(rank_col, F.row_number().over(w))


def share(cond: Column) -> Column:
    """Fraction of rows where ``cond`` holds (null counts as false), DOUBLE."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def histogram(df: DataFrame, col: str, bins: int = 80, positive_only: bool = True) -> DataFrame:
    """Equal-width histogram of ``col`` between its min and max.

    Rows: ``bin`` (0-based), ``bin_lo``, ``bin_hi``, ``n`` for non-empty
    bins; the last bin is closed on the right.  The bounds are resolved by
    one small job and used as literals; the counting is one partially
    aggregated group-by.
    """
    x = F.col(col)
    d = df.where(x.isNotNull() & (x > 0)) if positive_only else df.where(x.isNotNull())
    extent = d.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()   # two numbers
    lo, hi = F.lit(extent["lo"]).cast("double"), F.lit(extent["hi"]).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor((x - lo) / (hi - lo) * F.lit(float(bins))).cast("long")
    bin_of = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("long")
    counts = d.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def mean_and_count_by(facts: DataFrame, dims: DataFrame, key: str, value: str,
                      fact_groups: dict[str, Column], dim_groups: Sequence[str],
                      mean_name: str = "mean", count_name: str = "n",
                      broadcast_rows: int | None = 2_000_000) -> DataFrame:
    """``AVG(value)`` and ``COUNT(*)`` of ``facts JOIN dims USING(key)``
    grouped by fact-side expressions and dimension columns.

    The plan is chosen by a size check of ``dims``:

    * provably small -> broadcast hash join, then one partially aggregated
      group-by: the facts are never shuffled for the join;
    * otherwise -> the facts are first reduced to one row per
      ``(key, fact groups)`` (sum, non-null count, row count), so the
      shuffle join moves the reduced rows, and the partials are combined.
    """
    dim_side = dims.select(key, *dim_groups)
    out_groups = [*fact_groups.keys(), *dim_groups]
    if broadcast_rows is not None and provably_small(dim_side, broadcast_rows):
        j = facts.select(key, value, *[e.alias(n) for n, e in fact_groups.items()]) \
                 .join(F.broadcast(dim_side), on=key, how="inner")
        return j.groupBy(*out_groups).agg(F.avg(value).alias(mean_name),
                                          F.count(F.lit(1)).alias(count_name))
    pre = (facts.groupBy(F.col(key), *[e.alias(n) for n, e in fact_groups.items()])
           .agg(F.sum(value).alias("__s"), F.count(value).alias("__c"),
                F.count(F.lit(1)).alias("__n")))
    j = pre.join(dim_side, on=key, how="inner")
    return j.groupBy(*out_groups).agg((F.sum("__s") / F.sum("__c")).alias(mean_name),
                                      F.sum("__n").alias(count_name))


def exact_percentile(df: DataFrame, value: str, p: float, by: Sequence[str] = (),
                     out: str = "percentile", accuracy: int = 100_000,
                     also: Sequence[Column] = ()) -> DataFrame:
    """Exact interpolated percentile (``percentile(value, p)`` semantics)
    without holding a whole group in one aggregation buffer.

    1. Per group: row count and a mergeable GK sketch (``percentile_approx``,
       partial aggregation) read at ``p -+ e`` for a ladder of widths ``e``.
       The sketch's rank guarantee puts the needed order statistics inside
       the value band ``[lo, hi]`` of the narrowest safe width.
    2. One aggregation classifies every row as below / inside / above the
       band; below and above collapse to one counted row per group, the band
       (about ``6/accuracy`` of a large group) to distinct values with counts.
    3. A per-group running count over ``(class, value)`` gives each band
       value its exact rank range (below rows sort first), and the result
       interpolates between ranks ``floor``/``ceil`` of ``(n - 1) * p``
       exactly as Spark's ``percentile`` does.

    ``also`` are named aggregates over all rows of a group (``by`` must be given), computed in
    the pass of the sketch; then every group has a row, with a null percentile where it
    holds no value.

    Should the band ever miss a rank (it cannot while the sketch guarantee
    holds) the query fails loudly instead of returning a wrong value.

    Without ``by`` there is no key to deal the band's ranks by: see :func:`_select`.
    """
    from pyspark.sql import Window
    by = list(by)
    if not by:
        return _select(df, value, p, out, accuracy)
    d = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__x"))
    # band half-widths 1/2, 1/4, ... down to about 3/accuracy, all read from
    # one sketch; per group the narrowest one with a margin of at least
    # max(3n/accuracy, 3) ranks is used (the sketch's rank error is below
    # n/accuracy, plus one rank of rounding when it is still exact)
    ladder = [2.0 ** -k for k in range(1, 40) if 2.0 ** -k >= 3.0 / accuracy]
    kk = len(ladder)
    pcts = [max(0.0, p - e) for e in ladder] + [min(1.0, p + e) for e in ladder]
    source = df.withColumn("__x", F.col(value).cast("double")) if also else d
    sketch = source.groupBy(*by).agg(
        F.percentile_approx("__x", pcts, accuracy).alias("__q"),
        F.count("__x").alias("__n"), *also)
    names = [c for c in sketch.columns if c not in (*by, "__q", "__n")]
    need = F.greatest(F.lit(3.0 / accuracy), F.lit(3.0) / F.greatest(F.col("__n"), F.lit(1)))
    k = F.least(F.greatest(F.floor(-F.log2(need)), F.lit(1)), F.lit(kk)).cast("int")
    bounds = sketch.select(*by, *names, F.element_at("__q", k).alias("__lo"),
                           F.element_at("__q", k + kk).alias("__hi"),
                           ((F.col("__n") - 1) * F.lit(float(p))).alias("__pos"))
    # one row per group: computed once (the sketch pass), then broadcast
    # behind the size proof; beyond it a shuffle join (AQE splits a hot group)
    from pitpanel.session import materialize
    everything = materialize(bounds, "percentile-bounds")
    bounds = everything.drop(*names)
    small = provably_small(bounds)
    j = join_null_safe(d, F.broadcast(bounds) if small else bounds, by)
    x, lo, hi = F.col("__x"), F.col("__lo"), F.col("__hi")
    cls = F.when(x < lo, -1).when(x <= hi, 0).otherwise(1)
    classes = j.groupBy(*by, "__pos", cls.alias("__cls"), F.when(cls == 0, x).alias("__xb")) \
               .agg(F.count(F.lit(1)).alias("__c"))
    w = (Window.partitionBy(*by).orderBy("__cls", "__xb")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked_band = (classes.withColumn("__cum", F.sum("__c").over(w)).where(F.col("__cls") == 0)
                   .withColumn("__first", F.col("__cum") - F.col("__c"))
                   .withColumn("__last", F.col("__cum") - 1))
    pos = F.col("__pos")
    r_lo, r_hi = F.floor(pos), F.ceil(pos)

    def at(r):
        return F.max(F.when((F.col("__first") <= r) & (r <= F.col("__last")), F.col("__xb")))

    picked = ranked_band.groupBy(*by, "__pos").agg(at(r_lo).alias("__vlo"), at(r_hi).alias("__vhi"))
    vlo, vhi = F.col("__vlo"), F.col("__vhi")
    interp = (F.when(vlo.isNull() | vhi.isNull(),
                     F.raise_error(F.lit("exact_percentile: sketch band missed a rank")))
              .when((r_lo == r_hi) | (vlo == vhi), vlo)
              .otherwise((r_hi - pos) * vlo + (pos - r_lo) * vhi))
    found = picked.select(*by, interp.cast("double").alias(out))
    return join_null_safe(everything.select(*by, *names), found, by, how="left") if names else found


# distinct values that the last step of _select may bring to the driver
BAND_VALUES = 10_000


def _select(df: DataFrame, value: str, p: float, out: str, accuracy: int) -> DataFrame:
    """Exact interpolated percentile of a whole column, by distributed selection.

    The band of values that holds the two ranks starts as everything.  A pass over the band takes
    a sketch (partial aggregation) around the ranks, and one more counts the rows below and inside
    the narrower band: each round keeps about ``6/accuracy`` of the rows.  Once the band has at
    most ``BAND_VALUES`` distinct values, these are counted (again map-side first) and the ranks read off.
    Rows are never ordered or gathered: the driver sees counts, bounds and that last band.
    No rows where there is no value.
    """
    spark = df.sparkSession
    band = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("__x"))
    x = F.col("__x")
    distinct = F.approx_count_distinct("__x", 0.01)
    inside, kinds = band.agg(F.count(F.lit(1)), distinct).first()
    if not inside:
        return spark.createDataFrame([], f"{out} double")
    pos = (inside - 1) * p
    first, last, below = math.floor(pos), math.ceil(pos), 0
    while kinds > BAND_VALUES * 0.9:
        # rank errors of the sketch stay below inside / accuracy
        margin = max(3.0 / accuracy, 3.0 / inside)
        at = [max(0.0, (first - below) / inside - margin), min(1.0, (last - below + 1) / inside + margin)]
        lo, hi = band.agg(F.percentile_approx("__x", at, accuracy)).first()[0]
        within = x.between(F.lit(lo), F.lit(hi))
        under, held, kinds = band.agg(F.count_if(x < F.lit(lo)), F.count_if(within), F.approx_count_distinct(F.when(within, x), 0.01)).first()
        if not (below + under <= first and last < below + under + held):
            raise RuntimeError("exact_percentile: sketch band missed a rank")
        if held == inside:                  # as narrow as it gets
            break
        band, below, inside = band.where(within), below + under, held
    found = [None, None]
    for r in band.groupBy("__x").count().orderBy("__x").toLocalIterator():
        for i, rank in enumerate((first, last)):
            if found[i] is None and rank < below + r["count"]:
                found[i] = r["__x"]
        below += r["count"]
        if found[1] is not None:
            break
    a, b = found
    result = a if first == last or a == b else (last - pos) * a + (pos - first) * b
    return spark.range(1).select(F.lit(result).cast("double").alias(out))


def trailing_distinct(df: DataFrame, key: str, day: Column, days: int, lg_k: int = 14) -> DataFrame:
    """Distinct keys in the ``days`` days up to each day that has rows: ``day, n_estimate``.

    One HyperLogLog sketch per day (partial aggregation); a day's trailing count is the union of
    at most ``days`` sketches, so keys are never shuffled, and stored sketches of past days can
    be reused.  The standard error is about ``1.04 / sqrt(2^lg_k)`` (0.8 % at 14).  Rows without a key don't count.
    """
    daily = df.where(F.col(key).isNotNull()).groupBy(F.to_date(day).alias("__day")).agg(F.hll_sketch_agg(key, lg_k).alias("__s"))
    return union_trailing(daily, days)


def union_trailing(daily: DataFrame, days: int) -> DataFrame:
    """:func:`trailing_distinct` from the sketches of days (``__day``, ``__s``), e.g. stored ones."""
    reach = daily.select("__s", F.col("__day").alias("__own"), F.explode(F.sequence("__day", F.date_add("__day", days - 1))).alias("__day"))
    joined = reach.groupBy("__day").agg(F.hll_union_agg("__s").alias("__s"), F.max("__own").alias("__own"))
    return joined.where("__day = __own").select(F.col("__day").cast("timestamp_ntz").alias("day"), F.hll_sketch_estimate("__s").alias("n_estimate"))


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median",
                 **kw) -> DataFrame:
    """:func:`exact_percentile` at 0.5."""
    return exact_percentile(df, value, 0.5, by, out=out, **kw)
