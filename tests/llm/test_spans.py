"""Byte and word span deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest

from pitpanel.llm.hashing import mix
from pitpanel.llm.lz_dedup import duplicate_words
from pitpanel.llm.suffix_dedup import duplicate_bytes
from pitpanel.llm.windows import Shape, find_cells, window_keys


def byte_truth(rows, width):
    seen = {}
    for r, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            seen.setdefault(b[i:i + width], []).append((r, i))
    out = []
    for r, (d, t) in enumerate(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if len(seen[b[i:i + width]]) > 1:
                gone[i:i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def word_truth(rows, width):
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            least[k] = min(least.get(k, 1 << 62), 1 << 62 if d is None else d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i:i + width])] < (1 << 62 if d is None else d):
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["a", "bb", "éclair", "the", "of", "x1", "zz", "tab\tin", "日本"]
    passages = [" ".join(rng.choices(vocab, k=rng.randint(5, 40))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocab, k=rng.randint(1, 15))))
        rows.append((i, "\n".join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "aaaa " * 50), (n + 3, "aaaa " * 37 + "b"), (3, rows[3][1]), (None, rows[5][1]), (n + 4, " \t\n ")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bytes_match_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, payload int").repartition(4)
    for width in (16, 40):
        got = [tuple(r)[:5] for r in duplicate_bytes(df, width=width).collect()]
        assert sorted(got, key=str) == byte_truth(rows, width)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_words_match_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(4)
    for width in (4, 10):
        got = [tuple(r)[:4] for r in duplicate_words(df, width=width).collect()]
        assert sorted(got, key=str) == word_truth(rows, width)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_chunks_leave_the_cells_as_they_are(chunk):
    rng = np.random.default_rng(chunk)
    values = mix(rng.integers(0, 3, 2500).astype(np.uint64))
    bounds = np.array([0, 0, 3, 700, 700, 703, 1500, 1520, 2500, 2500])
    shape = Shape(24, 4, 5)
    whole, cut = find_cells(values, bounds, shape), find_cells(values, bounds, shape, chunk)
    for name in ("inner", "outer", "first", "last", "doc"):
        assert (getattr(whole, name) == getattr(cut, name)).all()
    # every window inside a document belongs to one cell
    windows = [s for a, b in zip(bounds[:-1], bounds[1:]) for s in range(a, b - 23)]
    assert [s for a, b in zip(cut.first, cut.last) for s in range(a, b + 1)] == windows
    at = np.array(windows)[::3]
    assert (window_keys(values, at, 24, chunk) == window_keys(values, at, 24)).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert duplicate_bytes(df).count() == 0
    assert duplicate_words(df).count() == 0
