"""Soft-membership mixing: totals meet targets, rates meet the optimality conditions."""

import random

import numpy as np
import pytest

from pitpanel.llm.mixing import calibration, fit_rates, mixed_rates, replay, with_rates

SF = "/root/testdata/sf0.01"


def totals(rows, k):
    out = np.zeros(k)
    for r in rows:
        out += r.rate * r.n_tokens * np.array(r.posterior)
    return out


@pytest.mark.parametrize("targets", [None, {"en": 0.1, "de": 0.3, "fr": 0.5, "es": 0.1}])
def test_targets_are_met_and_domains_recognised(spark, targets):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixed_rates(docs, labels, targets).collect()
    got = totals(rows, 4)
    want = np.array([(targets or {}).get(n, 0.25) for n in ("de", "en", "es", "fr")]) * sum(r.n_tokens for r in rows)
    assert np.abs(got - want).max() <= 0.011 * sum(r.n_tokens for r in rows) / 4
    assert min(r.rate for r in rows) >= 0
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert np.mean([lang[r.doc_id] == r.domain for r in rows if r.n_tokens > 20]) > 0.97


def test_optimality(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4] * 3, 200)
    n = rng.integers(0, 50, 200)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, posterior array<double>").repartition(3)
    goal, total = np.array([0.8, 0.2, 0.0]) * n.sum(), float(n.sum())
    history, residual = fit_rates(df, goal / total, 500.0, 150, 0.0)     # ends at a ridge of 0.05
    ridge = history[-1][2]
    rate, _ = replay(p, history)
    weight = total / (n @ p)
    slope = p @ (weight * ((rate * n) @ p - goal) / total) + ridge * (rate - 1)
    assert len(history) > 16        # rates were written and read back
    assert abs(np.abs((rate * n) @ p - goal).max() / total - residual) < 1e-9
    assert np.abs(slope[rate > 1e-9]).max() < 1e-4      # gradient zero where free,
    assert slope[rate <= 1e-9].min(initial=0) > -1e-4   # not pointing up where cut


def test_edges(spark):
    rng = random.Random(0)
    text = lambda w: " ".join(rng.choices(w, k=20))
    rows = [(i, text(["the", "cat"] if i % 3 else ["der", "hund"]), "en" if i % 3 else "de", 1.0) for i in range(60)]
    rows += [(100, None, "en", 1.0), (101, "", None, 1.0), (None, "the cat", "en", 1.0), (3, rows[3][1], "de", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rate double").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(None, 1), (3, 0)], "doc_id long, lang int")
    out = mixed_rates(docs, labels).collect()
    assert len(out) == len(rows)
    got = totals(out, 2)
    assert abs(got[0] - got[1]) < 0.02 * got.sum()
    assert len({r.rate for r in out if r.doc_id == 3}) == 1
    assert {r.rate for r in mixed_rates(docs, labels.limit(0)).collect()} == {1.0}
    assert mixed_rates(docs.limit(0), labels).count() == 0


def one_hot(spark, shares):
    """Rows of one domain each, of these shares of the tokens."""
    n = np.repeat(np.arange(len(shares)), 5)
    return spark.createDataFrame([(int(shares[k] * 20000), [float(k == j) for j in range(len(shares))]) for k in n], "n_tokens long, posterior array<double>").repartition(2)


@pytest.mark.parametrize("shares", [(.97, .01, .01, .01), (.33, .33, .33, .01), (.33, .33, .338, .002), (.70, .15, .10, .05)])
def test_targets_of_rare_domains_are_met(spark, shares):
    rows = one_hot(spark, shares)
    goal, total = np.full(4, 25000.0), 100000.0
    history, residual = fit_rates(rows, goal / total, 1e-3, 30, 0.01)
    got = rows.collect()
    p, n = np.array([r.posterior for r in got]), np.array([r.n_tokens for r in got])
    assert np.abs((replay(p, history)[0] * n) @ p - goal).max() <= 0.01 * total / 4 and residual <= 0.01 / 4


def test_targets_that_no_rates_meet_get_the_least_squares_solution(spark):
    """30 rows of one text under two labels: the prior as posterior, and the best common rate."""
    docs = spark.createDataFrame([(i, "the same words here", "a" if i % 3 else "b") for i in range(30)], "doc_id long, text string, lang string")
    rows = mixed_rates(docs, docs.select("doc_id")).collect()
    assert all(np.allclose(r.posterior, [2 / 3, 1 / 3]) for r in rows)
    # minimises 1.5 (2r/3 - 1/2)^2 + 3 (r/3 - 1/2)^2 but for the ridge: r = 1
    assert all(abs(r.rate - 1) < 0.01 and abs(r.residual - 1 / 6) < 0.01 for r in rows)
    steps, residual = fit_rates(spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.6, 0.4])], "n_tokens long, posterior array<double>"), np.array([0.1, 0.9]), 1e-3, 30, 0.01)
    assert residual > 0.01 and len(steps) < 400


def test_posteriors_are_calibrated(spark):
    """Words that say little: the posterior's claims hold on rows it never saw, for a rare domain too."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        d = "rare" if i % 6 == 0 else "often"
        rows.append((i, " ".join(rng.choices(words, [1 + (j < 30) * (d == "rare") for j in range(60)], k=rng.randint(1, 12))), d))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = {r.doc_id: r for r in mixed_rates(docs, docs.where("doc_id < 750").select("doc_id"), {"often": 5, "rare": 1}, per_domain=300).collect()}
    fresh = [(out[i].posterior[1], d == "rare") for i, _, d in rows if i >= 750]
    assert abs(np.mean([p for p, _ in fresh]) - np.mean([t for _, t in fresh])) < 0.05
    sure = [(max(p, 1 - p), (p > 0.5) == t) for p, t in fresh]
    assert abs(np.mean([c for c, _ in sure]) - np.mean([t for _, t in sure])) < 0.06
    bins = calibration(docs, docs.where("doc_id < 750").select("doc_id"), per_domain=300).collect()
    assert sum(r.n for r in bins) == sum(min(300, n) // 5 for n in (125, 625))


def test_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", 5, {"a": 1}), (None, None, None, None, None), (1, "the cat", "en", 5, {"a": 1}), (2, "der hund", "de", 6, None)],
                                 "doc_id long, text string, lang string, rate int, `odd.name` map<string,int>")
    out = with_rates(docs, docs.select("doc_id"))
    assert out.columns == ["doc_id", "text", "lang", "rate_input", "odd.name", "n_tokens", "domain", "posterior", "rate", "residual"]
    got = sorted((r.doc_id or 0, r.text, r.rate_input, r["odd.name"]) for r in out.collect() if r.text)
    assert got == [(1, "the cat", 5, {"a": 1}), (1, "the cat", 5, {"a": 1}), (2, "der hund", 6, None)] and out.count() == 4
    assert with_rates(docs, docs.limit(0)).columns == out.columns


def test_every_labelled_domain_is_learned(spark):
    rows = [(i, f"word{i % 70}x word{i % 70}y " * 10, f"d{i % 70:02}") for i in range(280)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    labels = spark.createDataFrame([(i,) for i in range(140)], "doc_id long")
    out = mixed_rates(docs, labels, per_domain=2, max_domains=64).collect()
    lang = {i: d for i, _, d in rows}
    assert {len(r.posterior) for r in out} == {70} and all(lang[r.doc_id] == r.domain for r in out)
    with pytest.raises(ValueError, match="xx"):
        mixed_rates(docs, labels, {"d00": 0.5, "xx": 0.5}, per_domain=2)
