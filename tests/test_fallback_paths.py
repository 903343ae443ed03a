"""The plans taken at scale (no broadcast) give the same rows as the small-data plans."""

from pyspark.sql import functions as F

from pitpanel.functions.timeparts import floor_to
from pitpanel.operators.filters import key_filter
from pitpanel.operators.stats import mean_and_count_by
from pitpanel.plans import fixtures as fx
from pitpanel.plans import loaders

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_current_shuffle_join_equals_broadcast(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p, c = fx.fx_prices(spark, SF), fx.fx_metadata_current(spark, SF)
        big = loaders.load_panel(p, c, columns=["name", "department"], sort=False, broadcast_rows=0)
        assert "SortMergeJoin" in _plan(big)
        small = loaders.load_panel(p, c, columns=["name", "department"], sort=False)
        assert "BroadcastHashJoin" in _plan(small)
        assert rows(big) == rows(small)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_then_aggregate_preaggregates_when_not_broadcast(spark):
    p, c = fx.fx_prices(spark, SF), fx.fx_metadata_current(spark, SF)
    groups = {"day": floor_to("fetched_at", "day")}
    a = mean_and_count_by(p, c, "sku", "sale_price", groups, ["department"], broadcast_rows=0)
    b = mean_and_count_by(p, c, "sku", "sale_price", groups, ["department"])
    q = lambda df: sorted((r.day, r.department, round(r.mean, 9), r.n) for r in df.collect())
    assert q(a) == q(b)


def test_key_filter_with_key_frame_without_broadcast(spark):
    p = fx.fx_prices(spark, SF)
    keys = fx.fx_metadata_active(spark, SF).select("sku")
    a = key_filter(p, "sku", keys, max_broadcast_rows=0)
    b = key_filter(p, "sku", keys)
    assert rows(a) == rows(b) and a.count() < p.count()


def test_long_key_list_becomes_semi_join(spark):
    p = fx.fx_prices(spark, SF)
    keys = [str(k) for k in range(1, 20_001)]
    a = key_filter(p, "sku", keys)
    assert "LeftSemi" in _plan(a) or "LeftSemi" in str(a._jdf.queryExecution().optimizedPlan())
    b = p.where(F.col("sku").cast("long").between(1, 20_000))
    assert rows(a) == rows(b)


def test_relative_prices_rejects_duplicate_cells(spark):
    import pytest
    from pitpanel.operators.reshape import relative_prices
    P = "sku string, fetched_at timestamp_ntz, sale_price double"
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    prices = spark.createDataFrame([("a", t, 1.0), ("a", t, 2.0), ("b", t, 4.0)], P)
    choice = spark.createDataFrame([("a", 1), ("b", 2)], "sku string, rank int")
    with pytest.raises(Exception, match="duplicate cell"):
        relative_prices(prices, choice, 2).collect()
    ok = relative_prices(prices.where("sale_price <> 2.0"), choice, 2).first()
    assert (ok.p1, ok.p2, ok.rel_2) == (1.0, 4.0, 4.0)
