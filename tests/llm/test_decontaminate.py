"""Latent semantic retrieval against brute force."""

import random
from collections import Counter

import numpy as np

from pitpanel.llm.decontaminate import contaminated, drop_contaminated, lcs_length, randomised_svd


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_lcs():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 20))] for _ in range(2))
        assert lcs_length(np.array(a), np.array(b)) == plain_lcs(a, b)


def test_svd(spark):
    rng = np.random.default_rng(0)
    dense = rng.standard_normal((40, 6)) @ rng.standard_normal((6, 300))
    space, values = randomised_svd(spark, [(np.arange(300), r) for r in dense], 300, 6)
    assert np.allclose(values, np.linalg.svd(dense)[1][:6])
    assert np.allclose(space.T @ space, np.eye(6), atol=1e-8)
    assert np.allclose(dense @ space @ space.T, dense, atol=1e-6)


def tables(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7)))
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < .4 else word() for _ in range(n)]
    items = [(i, text(rng.randint(12, 70))) for i in range(40)]
    docs, planted = [], set()
    for d in range(400):
        words = text(rng.randint(0, 600))
        if d % 4 == 0:
            i, w = rng.choice(items)
            w = list(w)
            if d % 8 == 0:                              # a paraphrase: some words changed, some left out
                w = [x if rng.random() > .1 else word() for x in w if rng.random() > .05]
            at = rng.randint(0, len(words))
            words = words[:at] + [x.upper() if rng.random() < .2 else x for x in w] + words[at:]
            planted.add((d, i))
        docs.append((d, " ".join(words), "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, " ".join(items[3][1]), "x")]
    bench = [(i, ", ".join(w)) for i, w in items] + [(100, None), (101, ""), (None, "the of and")]
    return spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(4), spark.createDataFrame(bench, "item_id long, text string"), planted


def test_planted_items_are_found_and_clean_documents_are_not(spark):
    docs, bench, planted = tables(spark)
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert (None, 3) in got
    got = {g for g in got if g[0] is not None}
    assert len(got & planted) >= 0.95 * len(planted)
    assert not got - planted
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {1000, 1001} <= ids and ids == {r.doc_id for r in docs.collect()} - {d for d, _ in got} - {None}


def test_blocks_and_empty_tables(spark):
    docs, bench, planted = tables(spark)
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench, block_items=15).collect()}
    assert len(got & planted) >= 0.95 * len(planted)
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == 403


def held(docs, items):
    """(document, item) where some stretch of a third more than the item's words holds its rule,
    tried at every word.  An item whose words are less than 0.6 in the document can't be held."""
    out = set()
    frequency = Counter(w for _, d in docs for w in set(d))
    rare = {i: sorted(set(w), key=lambda x: frequency[x])[:-(-len(set(w)) // 2)] for i, w in items}
    for d, words in docs:
        there = Counter(words)
        for i, item in items:
            if sum((there & Counter(item)).values()) < 0.6 * len(item):
                continue
            width = len(item) + len(item) // 3 + 1
            for s in range(max(1, len(words) - width + 1)):
                part = words[s:s + width]
                if len(set(part) & set(item)) >= 0.3 * len(set(item)) and plain_lcs(item, part) >= 0.6 * len(item) and len(set(part) & set(rare[i])) >= 0.5 * len(rare[i]):
                    out.add((d, i))
                    break
    return out


def test_recall_does_not_fall_with_the_size_of_the_benchmark(spark):
    rng = random.Random(3)
    common, words = ["the", "of", "and", "to", "in"], [f"w{i}" for i in range(6000)]
    text = lambda n: [rng.choice(common) if rng.random() < .3 else rng.choice(words) for _ in range(n)]
    items = [(i, text(rng.randint(8, 14))) for i in range(2100)]
    docs = []
    for d in range(120):
        body = text(rng.randint(100, 250))
        at = rng.randint(0, len(body))
        docs.append((d, body[:at] + (rng.choice(items)[1] if d % 6 else []) + body[at:]))
    truth = held(docs, items)
    assert len(truth) >= 95
    frames = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string").repartition(4), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(*frames, block_items=3000).collect()}
    assert len(got & truth) >= 0.9 * len(truth)
    assert not got - truth


def test_an_item_is_found_in_a_large_group_of_copies(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    copied = text(14)
    copy = text(60) + copied + text(60)
    docs = [(i, copy if i < 100 else text(110)) for i in range(300)]                       # a third of the rows
    frames = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string").repartition(4), spark.createDataFrame([(0, " ".join(copied))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(*frames).collect()} == {(i, 0) for i in range(100)}
