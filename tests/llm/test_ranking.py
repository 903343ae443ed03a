"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pitpanel.llm import ranking
from pitpanel.llm.queries import op12_geometric_blocks
from pitpanel.llm.ranking import Segment, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scored[:k], 1)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("block,docs_a_segment,seeds", [(4, 40, 1), (64, 8192, 64), (2, 100, 2)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, block, docs_a_segment, seeds):
    monkeypatch.setattr(ranking, "SEEDS", seeds)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)] + ["Éa", "é", "x_y", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 60))) for _ in range(500)]
    docs = [(i, t, "c") for i, t in enumerate(texts)] + [(1000 + i, texts[7], "c") for i in range(150)]
    docs += [(3, texts[3], "d"), (None, texts[4], "e"), (None, None, "f"), (1200, "", "g"), (1201, "w1 " * 30_000, "h")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 25))), "z") for i in range(20)]
    items += [(20, texts[7], "z"), (21, None, "z"), (22, "?!", "z"), (23, "w0", "z"), (23, "w0", "z"), (None, "w5 W5 é", "z")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string, doc_id string").coalesce(1)

    def small(batch, **kw):
        ranking.SEGMENT_DOCS = docs_a_segment
        return task(batch, **kw)

    # the sizes hold inside tasks, which import the module anew
    task = ranking._vectors_task
    monkeypatch.setattr(ranking, "_vectors_task", small)
    build = ranking._index_task

    def small_index(batch, **kw):
        ranking.BLOCK, ranking.SMALL = block, block
        return build(batch, **kw)

    monkeypatch.setattr(ranking, "_index_task", small_index)
    got = sorted((tuple(r) for r in ranked_search(d, q).collect()), key=key)
    assert got == sorted(brute([r[:2] for r in docs], [r[:2] for r in items]), key=key)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert ranked_search(d, q.limit(0)).count() == 0
    assert ranked_search(d.limit(0), q).count() == 0
    assert [tuple(r) for r in ranked_search(d, q).collect()] == brute([(1, "a b")], [(1, "a")])


def test_skipped_blocks_hold_no_better_document():
    """Every block's bound is at least the score of each of its documents."""
    rng = np.random.default_rng(1)
    n, v = 600, 50
    rows = [np.unique(rng.zipf(1.4, rng.integers(1, 30)) % v) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term = np.concatenate(rows).astype(np.int32)
    tf = rng.integers(1, 5, len(term)).astype(np.int32)
    raw = ranking.freeze(np.arange(n), np.zeros(n, dtype=bool), np.add.reduceat(tf, ptr[:-1]).astype(np.int64), ptr, term, tf)
    s = Segment(Segment.build(raw, n, int(tf.sum()), v))
    assert len(s.blocks) - 1 > v                                   # long lists have several blocks
    for _ in range(20):
        q = np.unique(rng.integers(0, v, 8))
        w = rng.integers(1, 9000, len(q))
        by_term = np.zeros(v, dtype=np.int64)
        by_term[q] = w
        blocks, bound = s.bounds(q, w)
        for b, most in zip(blocks.tolist(), bound.tolist()):
            assert s.scores(s.documents(np.array([b])), by_term).max() <= most
        for t in q.tolist():
            mine = np.concatenate([s.documents(np.array([b])) for b in range(s.lists[t], s.lists[t + 1])] or [[]])
            assert sorted(mine) == [d for d in range(n) if t in rows[d]]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(tuple(r) for r in op12_geometric_blocks(spark, sf).select("item_id", "rank", "doc_id", "score").collect())
    assert got == sorted(brute(docs, items))
