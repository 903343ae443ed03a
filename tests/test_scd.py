"""Change detection edge cases and the step-fold == backfill property."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pitpanel.functions.canonical import content_hash
from pitpanel.operators.scd import (as_of, as_of_many, build_index, change_log, dedupe_by_key,
                                    diff, validity_intervals)
from pitpanel.schemas import HASH_INDEX

D = dt.datetime
SNAP = "sku string, color string, observed_at timestamp_ntz"
IDX = "sku string, content_hash string, first_seen timestamp_ntz, last_seen timestamp_ntz"


def snap(spark, rows):
    df = spark.createDataFrame(rows, SNAP)
    return df.withColumn("content_hash", content_hash(["sku", "color"]))


def empty_index(spark):
    return spark.createDataFrame([], IDX)


def fold(spark, runs):
    """Apply diff run by run; return all changed rows and the final index."""
    index, changed = empty_index(spark), []
    for rows in runs:
        ch, index = diff(snap(spark, rows), index)
        index = spark.createDataFrame(index.collect(), IDX)   # materialise between steps
        changed += [(r.sku, r.color, r.observed_at) for r in ch.collect()]
    return sorted(changed), sorted(tuple(r) for r in index.collect())


def test_bootstrap_everything_changed(spark):
    ch, idx = diff(snap(spark, [("1", "red", D(2024, 1, 1)), ("2", "blue", D(2024, 1, 1))]), empty_index(spark))
    assert ch.count() == 2
    assert {r.sku: (r.first_seen, r.last_seen) for r in idx.collect()} == {
        "1": (D(2024, 1, 1), D(2024, 1, 1)), "2": (D(2024, 1, 1), D(2024, 1, 1))}


def test_absent_key_carried_and_same_content_is_no_change(spark):
    t1, t2, t3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    changed, index = fold(spark, [[("1", "red", t1), ("2", "blue", t1)],
                                  [("1", "red", t2)],                      # 2 absent
                                  [("1", "red", t3), ("2", "blue", t3)]])  # 2 back, same
    assert changed == [("1", "red", t1), ("2", "blue", t1)]
    idx = {r[0]: r for r in index}
    assert idx["2"][2] == t1 and idx["2"][3] == t3     # first_seen kept, last_seen moves


def test_absent_key_back_with_new_content(spark):
    t1, t2, t3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    changed, index = fold(spark, [[("2", "blue", t1)], [("1", "red", t2)], [("2", "green", t3)]])
    assert ("2", "green", t3) in changed
    assert {r[0]: r[2] for r in index}["2"] == t1


def test_a_b_a_gives_three_rows_and_same_day_changes_kept(spark):
    runs = [[("1", "A", D(2024, 1, 1, 0))], [("1", "B", D(2024, 1, 1, 6))], [("1", "A", D(2024, 1, 1, 12))]]
    changed, _ = fold(spark, runs)
    assert [c[1] for c in sorted(changed, key=lambda c: c[2])] == ["A", "B", "A"]


def test_duplicate_key_in_run_is_deduplicated(spark):
    df = snap(spark, [("1", "red", D(2024, 1, 1)), ("1", "red", D(2024, 1, 1)), ("2", "x", D(2024, 1, 1))])
    assert dedupe_by_key(df, "sku", ["content_hash"]).count() == 2


def test_fold_equals_backfill(spark):
    rnd = random.Random(3)
    times = [D(2024, 1, 1) + dt.timedelta(hours=6 * i) for i in range(12)]
    runs = [[(str(k), rnd.choice(["r", "g"]), t) for k in range(8) if rnd.random() < 0.8] for t in times]
    changed, index = fold(spark, runs)
    all_rows = snap(spark, [r for run in runs for r in run])
    back = sorted((r.sku, r.color, r.observed_at) for r in change_log(all_rows).collect())
    assert back == changed
    idx = sorted(tuple(r) for r in build_index(all_rows).collect())
    assert idx == index


def test_as_of_and_intervals(spark):
    h = snap(spark, [("1", "A", D(2024, 1, 1)), ("1", "B", D(2024, 2, 1)), ("2", "C", D(2024, 3, 1))])
    at = {r.sku: r.color for r in as_of(h, "2024-02-15").collect()}
    assert at == {"1": "B"}                      # key 2 not yet observed -> omitted
    many = {(r.sku, r.as_of.month): r.color for r in as_of_many(h, ["2024-01-15", "2024-03-15"], ["color"]).collect()}
    assert many == {("1", 1): "A", ("1", 3): "B", ("2", 3): "C"}
    iv = {(r.sku, r.color): r.valid_to for r in validity_intervals(h).collect()}
    assert iv == {("1", "A"): D(2024, 2, 1), ("1", "B"): None, ("2", "C"): None}


def test_index_schema_matches_declared(spark):
    assert [f.name for f in HASH_INDEX.fields] == ["sku", "content_hash", "first_seen", "last_seen"]


def test_grid_equals_the_state_at_each_moment(spark):
    import datetime as dt
    from pitpanel.operators.scd import as_of_grid, as_of_many
    t = lambda *a: dt.datetime(2026, 1, *a)
    rows = [("a", t(1), "x"), ("a", t(3, 12), "y"), ("a", t(3, 12), "z"), ("a", t(9), "w"), ("b", t(5), "p"), ("c", dt.datetime(2025, 1, 1), "q"),
            ("d", dt.datetime(2027, 1, 1), "r")]
    h = spark.createDataFrame(rows, "sku string, observed_at timestamp_ntz, v string")
    days = [t(2) + dt.timedelta(days=2 * i) for i in range(6)]
    want = sorted(tuple(r) for r in as_of_many(h, days, ["v"], tiebreak=("v",)).collect())
    got = as_of_grid(h, t(2), 6, ["v"], days=2, tiebreak=["v"], bucket_days=3).select("sku", "as_of", "observed_at", "v")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_counted_grid_equals_the_grid_counted(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from pitpanel.operators.scd import as_of_grid
    t = lambda *a: dt.datetime(2026, 1, *a)
    rows = [(k, t(d, h), v) for k, d, h, v in (("a", 1, 0, "x"), ("a", 3, 12, "y"), ("a", 3, 12, "z"), ("a", 9, 0, None), ("b", 1, 0, "x"),
                                               ("b", 5, 0, "y"), ("c", 9, 0, "x"), ("d", 20, 0, "x"), (None, 2, 0, "x"), (None, 4, 0, "y"))]
    h = spark.createDataFrame(rows, "sku string, observed_at timestamp_ntz, v string")
    grid = lambda **kw: as_of_grid(h, t(2), 6, ["v"], days=2, tiebreak=["v"], bucket_days=3, **kw)
    want = grid().groupBy("as_of", "v").agg(F.count(F.lit(1)).alias("n")).collect()
    counted = grid(count="n")
    assert sorted(map(repr, counted.collect())) == sorted(map(repr, want))
    # versions are counted before they are exploded over the grid
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate"):]
