"""Statistics operators against Spark's own exact aggregates / brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators.stats import exact_median, exact_percentile, histogram, top_k


@pytest.mark.parametrize("p", [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0])
def test_exact_percentile_equals_percentile(spark, p):
    rnd = random.Random(int(p * 1000))
    rows = []
    for g, n in enumerate([1, 2, 3, 4, 7, 50, 333, 4000, 30000]):
        rows += [(g, float(rnd.randrange(n // 3 + 2)) + rnd.random() * (g % 2)) for _ in range(n)]
    rows += [(99, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.percentile for r in exact_percentile(df, "v", p, ["g"]).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", p).alias("q")).collect() if r.q is not None}
    assert got == want
    assert exact_percentile(df, "v", p).first()[0] == df.agg(F.percentile("v", p)).first()[0]


def test_exact_median_one_hot_group(spark):
    big = spark.range(400_000).select((F.col("id") % 977 * 0.25).alias("v"), F.lit(1).alias("g"))
    assert exact_median(big, "v", ["g"]).first().median == big.agg(F.median("v")).first()[0]


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0.0, 1.0, 2.0, 5.0, 10.0]], "x double")
    h = {r.bin: r.n for r in histogram(df, "x", bins=5, positive_only=False).collect()}
    assert h == {0: 2, 1: 1, 2: 1, 4: 1}


def test_top_k_tiebreak_and_nulls(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 1)], "sku string, n int")
    assert [r.sku for r in top_k(df, "n", 3).collect()] == ["a", "b", "d"]


def test_broadcast_check_bounds_rows_and_bytes(spark):
    from pitpanel.operators.joins import provably_small
    df = spark.createDataFrame([("x" * 1000, 1)] * 50, "s string, n long")
    assert provably_small(df, max_rows=50, max_bytes=60_000)
    assert not provably_small(df, max_rows=49, max_bytes=60_000)
    assert not provably_small(df, max_rows=50, max_bytes=40_000)


def test_table_profile_and_first_row(spark):
    from pitpanel.operators.audit import first_row_profile, table_profile
    df = spark.createDataFrame([("b", None, "y" * 100), ("a", 2, None)], "k string, n int, t string")
    prof = {r.column: (r.null_count, r.n_rows) for r in table_profile(df).collect()}
    assert prof == {"k": (0, 2), "n": (1, 2), "t": (1, 2)}
    first = {r.column: r.value for r in first_row_profile(df, ["k"]).collect()}
    assert first == {"k": "a", "n": "2", "t": None}
    first_b = {r.column: r.value for r in first_row_profile(df, ["n"]).collect()}
    assert len(first_b["t"]) == 80 and first_b["t"].endswith("...")


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "hot"])
def test_select_narrows_without_ordering(spark, monkeypatch, kind):
    """Percentiles of a whole column by rounds of sketches and counts."""
    from pitpanel.operators import stats
    monkeypatch.setattr(stats, "BAND_VALUES", 50)
    x = {"spread": "rand(7) * 1e6", "ties": "cast(id % 700 as double)", "few": "cast(id % 7 as double)",
         "hot": "case when id % 3 = 0 then 5.0 else rand(3) end"}[kind]
    d = spark.range(0, 60_001).select(F.expr(x).alias("x"))
    d = d.union(spark.createDataFrame([(None,)], "x double"))
    for p in (0.0, 0.123, 0.5, 1.0):
        got = stats.exact_percentile(d, "x", p, accuracy=2000)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.first()[0] == d.select(F.percentile("x", p)).first()[0]
    assert stats.exact_percentile(d.limit(0), "x", 0.5).count() == 0


def test_trailing_sketches_can_be_stored_by_day(spark, tmp_root):
    from pitpanel.operators.stats import trailing_distinct, union_trailing
    d = spark.range(0, 30_000).select(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("d"),
                                      (F.col("id") * 7 % 5000).cast("string").alias("k"))
    d.groupBy(F.col("d").alias("__day")).agg(F.hll_sketch_agg("k", 14).alias("__s")).write.parquet(f"{tmp_root}/days")
    got = {r["day"]: r["n_estimate"] for r in union_trailing(spark.read.parquet(f"{tmp_root}/days"), 3).collect()}
    assert got == {r["day"]: r["n_estimate"] for r in trailing_distinct(d, "k", F.col("d"), 3).collect()}
    assert len(got) == 9 and all(abs(n - 5000) < 200 for day, n in got.items() if day.day >= 3)
