"""Keyed sequence operators against brute force on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitpanel.operators.sequence import asof_join, with_neighbor

D = dt.datetime


def _ts(day, hour=0):
    return D(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def brute_asof(left, right, strict=False):
    out = []
    for k, t, lid in left:
        cands = [(rt, tb, v) for rk, rt, tb, v in right if rk == k and (rt < t if strict else rt <= t)]
        best = max(cands) if cands else None
        out.append((lid, best[2] if best else None, best[0] if best else None))
    return sorted(out, key=repr)


def run_asof(spark, left, right, strict=False, bucket_days=1):
    l = spark.createDataFrame(left, "k string, t timestamp_ntz, lid long")
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, tb long, v string")
    res = asof_join(l, r, "k", "t", "rt", {"v": "v", "rt": "matched_at"}, strict=strict,
                    tiebreak="tb", bucket_days=bucket_days)
    return sorted(((x.lid, x.v, x.matched_at) for x in res.collect()), key=repr)


@pytest.mark.parametrize("seed,strict,bucket", [(1, False, 1), (2, True, 1), (3, False, 3), (4, True, 7)])
def test_asof_matches_brute_force(spark, seed, strict, bucket):
    rnd = random.Random(seed)
    keys = ["a", "b", "c", None]
    # key "a" is hot: most rows, spread over many buckets
    left = [(rnd.choice(["a"] * 6 + keys), _ts(rnd.randrange(30), rnd.randrange(24)), i) for i in range(300)]
    right = [(rnd.choice(["a"] * 6 + keys), _ts(rnd.randrange(30), rnd.randrange(24)), i,
              f"v{i}") for i in range(120)]
    # exact time ties between sides and within the right side
    right += [(k, t, 1000 + j, "tie") for j, (k, t, _) in enumerate(left[:10])]
    got = run_asof(spark, left, right, strict, bucket)
    want = brute_asof([x for x in left], [x for x in right if x[0] is not None], strict)
    assert got == want


def test_asof_keeps_null_attribute_of_matched_version(spark):
    # version 2 has a null attribute; it must not be filled from version 1
    l = spark.createDataFrame([("a", _ts(5), 1)], "k string, t timestamp_ntz, lid long")
    r = spark.createDataFrame([("a", _ts(1), "x", "y"), ("a", _ts(3), None, "z")],
                              "k string, rt timestamp_ntz, c1 string, c2 string")
    row = asof_join(l, r, "k", "t", "rt", ["c1", "c2"]).first()
    assert row.c1 is None and row.c2 == "z"


def test_asof_unmatched_rows_kept(spark):
    l = spark.createDataFrame([("a", _ts(0), 1), ("z", _ts(9), 2)], "k string, t timestamp_ntz, lid long")
    r = spark.createDataFrame([("a", _ts(1), "x")], "k string, rt timestamp_ntz, v string")
    rows = {x.lid: x.v for x in asof_join(l, r, "k", "t", "rt", ["v"]).collect()}
    assert rows == {1: None, 2: None}


@pytest.mark.parametrize("direction,bucket", [("prev", 1), ("next", 1), ("prev", 5), ("next", 10)])
def test_with_neighbor_matches_brute_force(spark, direction, bucket):
    rnd = random.Random(7)
    rows, seen = [], set()
    while len(rows) < 200:
        k, t = rnd.choice("aaaabc"), _ts(rnd.randrange(60), rnd.randrange(24))
        if (k, t) not in seen:
            seen.add((k, t))
            rows.append((k, t, len(rows)))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v long")
    got = {r.v: (r.nb.v if r.nb else None)
           for r in with_neighbor(df, "k", "t", ["v"], direction=direction, bucket_days=bucket,
                                  out="nb").collect()}
    want = {}
    for k in set(r[0] for r in rows):
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for i, r in enumerate(seq):
            j = i - 1 if direction == "prev" else i + 1
            want[r[2]] = seq[j][2] if 0 <= j < len(seq) else None
    assert got == want


def test_constant_key_sequence_spans_buckets(spark):
    # a constant key (all runs) is the hottest possible key
    rows = [(_ts(d, h), f"r{d}-{h}") for d in range(20) for h in (0, 6, 12, 18)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, id string").withColumn("all", F.lit(0))
    res = with_neighbor(df, "all", "t", ["id"], direction="prev", out="p").collect()
    got = {r.id: (r.p.id if r.p else None) for r in res}
    ordered = [r[1] for r in sorted(rows)]
    assert got == {ordered[i]: (ordered[i - 1] if i else None) for i in range(len(ordered))}


def test_null_key_rows_have_no_neighbour(spark):
    df = spark.createDataFrame([(None, _ts(0), 1), (None, _ts(40), 2), ("a", _ts(0), 3), ("a", _ts(40), 4)],
                               "k string, t timestamp_ntz, v long")
    got = {r.v: (r.p.v if r.p else None) for r in with_neighbor(df, "k", "t", ["v"], out="p").collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


@pytest.mark.parametrize("strategy,width", [("broadcast", 7), ("shuffle", 7), ("auto", 7),
                                            ("broadcast", "auto"), ("shuffle", "auto")])
def test_point_in_time_strategies_agree_with_brute_force(spark, strategy, width):
    from pitpanel.operators.asof import point_in_time
    rnd = random.Random(11)
    prices = [(rnd.choice("aaaabcd"), _ts(rnd.randrange(90), rnd.randrange(24)), i) for i in range(400)]
    hist, seen = [], set()
    for i in range(80):
        k, t = rnd.choice("aaabcx"), _ts(rnd.randrange(90), rnd.randrange(24))
        hist.append((k, t, f"c{i}", f"h{i:03d}"))
    hist += [(k, t, "tie-lo", "h000"), (k, t, "tie-hi", "h999")] if (k := "a") and (t := prices[0][1]) else []
    p = spark.createDataFrame(prices, "sku string, fetched_at timestamp_ntz, pid long")
    h = spark.createDataFrame(hist, "sku string, observed_at timestamp_ntz, color string, content_hash string")
    got = sorted((r.pid, r.color, r.metadata_observed_at)
                 for r in point_in_time(p, h, ["color"], bucket_days=width, strategy=strategy).collect())
    want = []
    for k, t, pid in prices:
        c = [(ht, hh, col) for hk, ht, col, hh in hist if hk == k and ht <= t]
        best = max(c) if c else None
        want.append((pid, best[2] if best else None, best[0] if best else None))
    assert got == sorted(want)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 40)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=_rows, right=_rows, strict=st.booleans(), bucket=st.sampled_from([1, 3, 10, 100]))
def test_asof_property(spark, left, right, strict, bucket):
    L = [(k, _ts(d // 4, (d % 4) * 6), i) for i, (k, d) in enumerate(left)]
    R = [(k, _ts(d // 4, (d % 4) * 6), i, f"v{i}") for i, (k, d) in enumerate(right)]
    got = run_asof(spark, L, R, strict, bucket)
    want = brute_asof(L, [x for x in R if x[0] is not None], strict)
    assert got == want


def test_auto_bucket_width(spark):
    from pitpanel.operators.sequence import suggest_bucket_days
    # 10 keys, one row per key every 6 hours for 200 days -> 4 rows/key/day -> 32-day buckets
    rows = [(str(k), _ts(d, h)) for k in range(10) for d in range(200) for h in (0, 6, 12, 18)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz").withColumn("v", F.lit(1))
    assert 28 <= suggest_bucket_days(df, "k", "t") <= 36
    a = with_neighbor(df, "k", "t", ["t"], bucket_days="auto", out="p")
    b = with_neighbor(df, "k", "t", ["t"], bucket_days=1, out="p")
    assert sorted((r.k, r.t, r.p) for r in a.collect()) == sorted((r.k, r.t, r.p) for r in b.collect())


def test_asof_summary_sorts_no_left_rows(spark):
    """Buckets with left rows are distinct keys and buckets; greatest rows are sought among right rows alone."""
    left = [("a", _ts(d), d) for d in (0, 1, 5, 40)] + [(None, _ts(3), 99), ("b", None, 98), ("c", _ts(2), 97)]
    right = [("a", _ts(1), 1, "x"), ("a", _ts(1), 2, "y"), ("a", _ts(6), 1, None), ("b", _ts(0), 1, "z"), (None, _ts(0), 1, "n")]
    l = spark.createDataFrame(left, "k string, t timestamp_ntz, lid long")
    r = spark.createDataFrame(right, "k string, rt timestamp_ntz, tb long, v string")
    out = asof_join(l, r, "k", "t", "rt", {"v": "v", "rt": "matched_at"}, tiebreak="tb", bucket_days=1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "max(__pp_side" not in plan and "CASE WHEN (__pp_side" not in plan
    got = {x.lid: (x.v, x.matched_at) for x in out.collect()}
    assert got == {0: (None, None), 1: ("y", _ts(1)), 5: ("y", _ts(1)), 40: (None, _ts(6)), 99: (None, None), 98: (None, None), 97: (None, None)}
