"""Class-conditional Kneser-Ney models: definition, held-out accuracy, edge cases."""

import math

import numpy as np
import pytest

from pitpanel.llm.hashing import Lookup
from pitpanel.llm.toxicity import Model, passages, toxicity_scores

SF = "/root/testdata/sf0.1"


def brute(words, counts, order, discount, word):
    """Log ratio of a word by the recursion, with dictionaries of strings."""
    def probability(c, h, x):
        n = len(h) + 1
        hits, total = {}, 0
        for w, (o, t) in zip(words, counts):
            s = b"\x02" + w + b"\x03"
            for i in range(1, len(s)):
                if i >= n - 1 and s[i - n + 1:i] == h:
                    whole = i == n - 1 or n == order
                    k = (o + t if whole else 1) if n == 1 else ((o, t)[c] if whole else (o, t)[c] > 0)
                    hits[s[i]] = hits.get(s[i], 0) + k
                    total += k
        lower = 1 / 256 if n == 1 else probability(c, h[1:], x)
        if not total:
            return lower
        left = sum(min(v, discount) for v in hits.values()) / total
        return max(hits.get(x, 0) - discount, 0) / total + left * lower

    s = b"\x02" + word + b"\x03"
    out = 0
    for i in range(1, len(s)):
        h = s[max(0, i - order + 1):i]
        out += math.log(probability(1, h, s[i]) / probability(0, h, s[i]))
    return out


def test_model_matches_recursion():
    words = [b"abab", b"abc", b"ba", b"cc", "é".encode(), b"cab"]
    counts = [(3, 0), (1, 2), (0, 4), (2, 2), (1, 0), (0, 1)]
    for order in (2, 3, 4):
        m = Model(words, [o for o, _ in counts], [t for _, t in counts], order=order)
        asked = [*words, b"a", b"zzz", b"abz", b"cabab"]
        for w, got in zip(asked, m.evidence(asked)):
            assert got == pytest.approx(brute(words, counts, order, 0.75, w), abs=1e-4)


def test_lookup():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    keys[:64] = np.arange(64, dtype=np.uint64) << np.uint64(32)         # all want one slot
    table = Lookup(keys, np.arange(len(keys), dtype=np.float32) + 1)
    got, there = table.get(keys[1:])
    assert there.all() and (got == np.arange(1, len(keys)) + 1).all()
    assert not table.get(rng.integers(0, 1 << 63, 100).astype(np.uint64))[1].any()


def test_passages():
    got = passages(np.array([1., 5., 0., 0., 3., 2.]), np.array([0, 0, 4, 5, 6]), 2)
    assert got.tolist() == [0, 3, 3, 2]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    # two fifths of these toxic labels stand on texts without any toxic word
    assert len(toxic) > 30 and right > 0.93
    assert np.mean([t > c for t in toxic for c in clean]) > 0.86


def test_edges(spark):
    texts = [(i, "you idiot fool" if i % 2 else "a fine day", 7) for i in range(60)] + [(100, None, 1), (101, "", 1), (None, "fool", 1), (3, "a fine day", 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (5, None, "x"), (5, 1, "x")], "doc_id long, toxic int, text string")
    rows = toxicity_scores(docs, labels).collect()
    assert len(rows) == len(texts)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id not in (None, 100, 101, 3))
    assert len({r.score for r in rows if r.doc_id in (100, 101)}) == 1
    assert toxicity_scores(docs, labels.where("toxic = 0")).agg({"score": "max"}).first()[0] == 0
    assert toxicity_scores(docs.limit(0), labels).count() == 0
