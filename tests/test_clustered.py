"""Clustered tables: results equal those of plain tables, and plans have no exchange."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import colocated, scd
from pitpanel.operators.asof import point_in_time
from pitpanel.plans.loaders import load_panel
from pitpanel.sinks.clustered import HOT, open_clustered, plan_layout, write_clustered

BUCKETS = 16
T0 = dt.datetime(2020, 1, 1)


def tables(spark, seed):
    """Prices, history and catalog; one key has a third of the prices and of the history."""
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.34 else f"k{rng.randrange(60)}"
    when = lambda: T0 + dt.timedelta(days=rng.randrange(400))
    prices = [(key(), when(), float(i)) for i in range(900)] + [(None, T0, -1.0), ("lonely", T0, -2.0)]
    history = [(k, t, rng.choice("abc"), h) for (k, t), h in {(key(), when()): f"{rng.randrange(3)}" for _ in range(700)}.items()]
    history += [(k, t, "z", "9") for k, t, _, _ in history[:40]] + [(None, T0, "n", "0")]      # equal times: the greater hash counts
    catalog = [(f"k{i}", f"name{i}") for i in range(0, 60, 2)] + [("hot", "the hot one"), (None, "nobody")]
    return (spark.createDataFrame(prices, "sku string, fetched_at timestamp, price double").repartition(5),
            spark.createDataFrame(history, "sku string, observed_at timestamp, class string, content_hash string").repartition(4),
            spark.createDataFrame(catalog, "sku string, name string"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def exchanges(df):
    """Exchanges of the plan that move rows of buckets (the few hot keys' branch is left out)."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(params=[1, 2])
def written(spark, tmp_root, request):
    plain = tables(spark, request.param)
    layout = plan_layout(plain, "sku", BUCKETS, tmp_root)
    assert [r.sku for r in layout.hot_keys.collect()] == ["hot"]
    for i, t in enumerate(plain):
        write_clustered(t, layout, f"{tmp_root}/{i}")
    return plain, [open_clustered(spark, f"{tmp_root}/{i}") for i in range(3)]


def test_results_equal_those_of_plain_tables(written):
    (prices, history, catalog), (p, h, c) = written
    for plain, clustered in zip((prices, history, catalog), (p, h, c)):
        assert rows(clustered.rows()) == rows(plain)
        assert {r.sku for r in clustered.hot.collect()} <= {"hot", None}
    assert rows(colocated.panel(p, c, ["name"])) == rows(load_panel(prices, catalog, columns=["name"], sort=False))
    want = point_in_time(prices, history, ["class"], strategy="shuffle")
    assert rows(colocated.panel_historical(p, h, ["class"])) == rows(want)
    assert rows(colocated.build_index(h)) == rows(scd.build_index(history))


def test_change_log_equals_that_of_plain_tables(spark, tmp_root):
    _, history, _ = tables(spark, 3)
    snapshots = history.where("sku is not null").dropDuplicates(["sku", "observed_at"])
    snapshots = snapshots.withColumn("content_hash", F.when(F.col("content_hash") != "1", F.col("content_hash")))     # null hashes too
    held = spark.createDataFrame(snapshots.collect(), snapshots.schema)
    clustered = write_clustered(held, plan_layout([held], "sku", BUCKETS, tmp_root), f"{tmp_root}/s")
    assert rows(colocated.change_log(clustered)) == rows(scd.change_log(held))


def test_plans_over_buckets_have_no_exchange(spark, written):
    _, (p, h, c) = written
    none = lambda t: type(t)(t.key, t.buckets, t.cold, t.hot.limit(0).where("false"))
    p, h, c = none(p), none(h), none(c)
    assert exchanges(colocated.panel(p, c, ["name"])) == 0
    assert exchanges(colocated.build_index(h)) == 0
    assert exchanges(colocated.change_log(h)) == 0
    assert exchanges(colocated.panel_historical(p, h, ["class"])) == 0
    plan = colocated.panel_historical(p, h, ["class"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_hot_keys_are_few(spark, tmp_root):
    """However the rows lie, fewer than buckets / HOT keys are hot; an empty table has none."""
    df = spark.createDataFrame([(f"k{i}",) for i in range(5) for _ in range(100)], "sku string")
    assert plan_layout([df], "sku", 64, f"{tmp_root}/a").hot_keys.count() == 5 <= 64 / HOT
    assert plan_layout([df], "sku", 4, f"{tmp_root}/b").hot_keys.count() == 0
    empty = df.limit(0)
    layout = plan_layout([empty], "sku", 8, f"{tmp_root}/c")
    assert write_clustered(empty, layout, f"{tmp_root}/e").rows().count() == 0


def test_tables_of_different_layouts_are_refused(spark, tmp_root):
    df = spark.createDataFrame([("a", 1)], "sku string, x int")
    a, b = (write_clustered(df, plan_layout([df], "sku", n, f"{tmp_root}/l{n}"), f"{tmp_root}/t{n}") for n in (4, 8))
    with pytest.raises(ValueError, match="layouts"):
        colocated.panel(a, b, ["x"])
