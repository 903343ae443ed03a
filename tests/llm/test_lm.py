"""Deleted interpolation against a direct implementation."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from pitpanel.llm.lm_score import bucket_of, interpolated_scores, learn_weights, perplexity


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def toks(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + ["</s>"]


def direct(rows, order):
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode())
    train = [toks(t) for d, t in rows if crc(d) % 5 != 1]
    deleted = [toks(t) for d, t in rows if crc(d) % 5 != 1 and crc(d) // 5 % 10 == 0]
    kept = [toks(t) for d, t in rows if crc(d) % 5 != 1 and crc(d) // 5 % 10 != 0]

    def counts(texts):
        grams, contexts = Counter(), Counter()
        for t in texts:
            padded = ["<s>"] * (order - 1) + t
            for i in range(len(t)):
                for k in range(1, order + 1):
                    h = tuple(padded[i + order - k:i + order - 1])
                    grams[h, t[i]] += 1
                    contexts[h] += 1
        return grams, contexts

    v = len({w for t in train for w in t})

    def p(model, weights, h, w, upto):
        grams, contexts = model
        q = 1 / (v + 1)
        for k in range(1, upto + 1):
            hk = h[len(h) - k + 1:] if k > 1 else ()
            c = contexts[hk]
            b = 0 if k == 1 and c else int(bucket_of(__import__("numpy").array([c]))[0])
            lam = weights[k - 1][b + 1]
            q = lam * (grams[hk, w] / c if c else 0) + (1 - lam) * q
        return q

    model_kept, weights = counts(kept), []
    for k in range(1, order + 1):
        hist = Counter()
        for t in deleted:
            padded = ["<s>"] * (order - 1) + t
            for i, w in enumerate(t):
                h = tuple(padded[i:i + order - 1])
                hk = h[len(h) - k + 1:] if k > 1 else ()
                c = model_kept[1][hk]
                if not c:
                    continue
                b = 0 if k == 1 else c.bit_length() - 1
                r = model_kept[0][hk, w] / c / p(model_kept, weights, h, w, k - 1)
                hist[b, round(64 * math.log2(r)) if r else -(1 << 30)] += 1
        weights.append(learn_weights([(b, g, n) for (b, g), n in hist.items()]))
    model = counts(train)
    n_tok = sum(len(t) for t in train)
    uni = Counter(w for t in train for w in t)
    out = []
    for d, text in rows:
        t = toks(text)
        padded = ["<s>"] * (order - 1) + t
        s = sum(math.log10(p(model, weights, tuple(padded[i:i + order - 1]), w, order)) for i, w in enumerate(t))
        base = sum(math.log10((uni[w] + .5) / (n_tok + .5 * (v + 1))) for w in t)
        out.append((d, crc(d) % 5 == 1, len(t), sum(uni[w] > 0 for w in t), n_tok, base, s))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{int(rng.paretovariate(0.8))}" for _ in range(60)] + ["The", "é", "A b"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 40)))) for i in range(150)]
    return rows + [(900, None), (901, ""), (902, "  \n"), (None, "the end"), (5, rows[5][1]), (903, "never seen words here")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_direct_model(spark, order):
    rows = corpus(order)
    df = spark.createDataFrame([(*r, 2.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    got = sorted((tuple(r) for r in interpolated_scores(df, order=order).collect()), key=str)
    want = direct(rows, order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-3)


def test_empty_and_untrained(spark):
    assert interpolated_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = interpolated_scores(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)


def test_beats_unigram_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scores = interpolated_scores(df)
    model = {r.held_out: r.perplexity for r in perplexity(scores).collect()}
    base = {r.held_out: r.perplexity for r in perplexity(scores, "base_score").collect()}
    assert model[True] < base[True]
