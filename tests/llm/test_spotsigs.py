"""SpotSigs against a direct implementation."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pitpanel.llm import spotsigs
from pitpanel.llm.spotsigs import ANCHORS, dealt, edited_fingerprints, similar_fingerprints, with_next


def chains(t):
    words = re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            rest = [x for x in words[i + 1:] if x not in ANCHORS][:2]
            if len(rest) == 2:
                out.add((w, *rest))
    return out or {tuple(words)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def corpus():
    rng = random.Random(0)
    vocab = ["the", "of", "der", "la", "a", "is", "Fox", "dog,", "x1", "élan", "run!", "日本", "theory"]
    rows = [(i * 3, " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(120)]
    return rows + [(1000, None), (1001, ""), (5000, "the the of"), (7, rows[9][1]), (8, rows[9][1])]


@pytest.mark.parametrize("rows_each", [500, 7])
def test_matches_direct_implementation(spark, monkeypatch, rows_each):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", rows_each)
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, next string").repartition(4)
    got = {r.doc_id: r for r in edited_fingerprints(df).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    assert len(got) == len(rows)
    prints = {}
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(chains(t), chains(edited)))
        assert r.near_next == pytest.approx(jaccard(chains(t), chains(after)))
        assert prints.setdefault(frozenset(chains(t)), r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 8 * len(chains(t))
    assert len(set(prints.values())) == len(prints)


def test_edges(spark):
    nulls = spark.createDataFrame([(None, "the red fox"), (None, None), (4, "a")], "doc_id long, text string")
    assert edited_fingerprints(nulls).count() == 3
    one = edited_fingerprints(nulls.where("doc_id = 4")).first()
    assert (one.near_edited, one.near_next) == (1.0, 1.0)
    assert edited_fingerprints(nulls.limit(0)).count() == 0


def test_uneven_ids_stay_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 5)
    ids = [(s << 40) + i for s in (-3, 0, 1, 9) for i in range(60)] + [(5 << 50) + i * i * i for i in range(30)] + [-(1 << 63), (1 << 63) - 1]
    rows = [(i, f"the w{k} of x{k}") for k, i in enumerate(ids)] + [(77 << 41, f"the fox {k} of dog {k}") for k in range(90)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hashed = df.withColumn("hash", F.xxhash64("text"))
    sizes = [r["count"] for r in dealt(hashed, 5, len(rows), len(rows), min(ids), max(ids)).groupBy("known", "at", "part").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 20
    got = {r.doc_id: r.edited_sha256 for r in edited_fingerprints(df.where(F.col("doc_id") != 77 << 41)).collect()}
    order = sorted(((d, t) for d, t in rows if d != 77 << 41), reverse=True)
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        assert got[d] == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
    # rows of one id follow each other: each row's text is the next one of exactly one row
    chain = with_next(df, ["doc_id", "text"]).collect()
    assert sorted((r.next_doc_id, r.next_text) for r in chain) == sorted(rows)
    follow = {(r.doc_id, r.text): (r.next_doc_id, r.next_text) for r in chain}
    at, seen = rows[0], 0
    while seen == 0 or at != rows[0]:
        at, seen = follow[at], seen + 1
    assert seen == len(rows)


def test_similar_pairs(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 99)}"
        rows.append((i, " the ".join(words)))
    rows += [(100, rows[0][1]), (None, rows[1][1]), (101, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members, pairs = similar_fingerprints(df, 0.8)
    least = {}
    for d, t in rows:
        if d is not None:
            least[frozenset(chains(t))] = min(d, least.get(frozenset(chains(t)), d))
    sets = sorted((v, k) for k, v in least.items())
    want = {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1:] if jaccard(x, y) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
    assert sorted(((r.doc_id, r.class_id) for r in members.collect()), key=str) == sorted(((d, least[frozenset(chains(t))]) for d, t in rows), key=str)
