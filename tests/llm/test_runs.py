"""Periodic runs against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from pitpanel.llm.queries import op11_repair_runs
from pitpanel.llm.runs import Grammar, find_runs, group_runs, periodic_runs, repeated_tail


def brute(words):
    """Runs by trying every period and every stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)         # smallest period first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(kept)))


def random_words(rng):
    kind = rng.randrange(5)
    n = rng.randrange(0, 160)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return [rng.choice("abcdefgh") for _ in range(n)]
    if kind == 2:
        return [rng.choice("abc") for _ in range(rng.randrange(1, 40))] * rng.randrange(1, 5)
    if kind == 3:
        block = ["a"] * rng.randrange(1, 30) + ["b"]
        return block * rng.randrange(1, 6)
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        firsts = np.cumsum([0, *map(len, docs)])
        values = np.array([ord(w) * 0x9E3779B97F4A7C15 % 2 ** 64 for d in docs for w in d], dtype=np.uint64)
        start, end, q = find_runs(values, firsts)
        got = [[] for _ in docs]
        for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()):
            d = int(np.searchsorted(firsts, s, side="right")) - 1
            got[d].append((s - int(firsts[d]), e - s, p))
        assert got == [brute(d) for d in docs]


def test_grammar_derives_the_text():
    rng = random.Random(5)
    text = [rng.randrange(3) for _ in range(400)] * 3 + [0] * 33
    g = Grammar(np.array(text), np.array([0, 100, 100, len(text)]))
    assert len(g.symbols) < len(text) / 2
    halves = {g.n_terminals + i: (int(a), int(b)) for i, (a, b) in enumerate(zip(g.left, g.right))}

    def derive(x):
        return [x] if x not in halves else derive(halves[x][0]) + derive(halves[x][1])

    assert [w for s in g.symbols.tolist() for w in derive(s)] == text
    for i, at in enumerate(g.at.tolist()):
        x = g.n_terminals + i
        assert derive(x) == text[at:at + int(g.size[x])]


def test_query_and_hard_rows(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(random_words(rng)) + ("\n" if i % 3 else ""), "x") for i in range(120)]
    rows += [(3, "a " * 30, None), (3, "a " * 30, None), (None, "b c " * 9, "y"), (200, None, "z"), (201, "", "z"), (202, " \n\t", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    got = periodic_runs(docs, rewrite=repeated_tail).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = [(i, *expected(i, t)) for i, t, _ in rows if i is not None]
    assert sorted(((r["doc_id"], *r[1:8]) for r in got if r["doc_id"] is not None), key=key) == sorted(want, key=key)
    null = next(r for r in got if r["doc_id"] is None)
    assert (null["n_runs"], null["length"], null["period"], null["collapsed"]) == (1, 18, 2, "b c")
    assert periodic_runs(docs.limit(0)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    short = {i: t for i, t in texts.items() if len(t or "") < 6000}
    got = {r["doc_id"]: tuple(r[1:]) for r in op11_repair_runs(spark, sf).collect()}
    assert len(got) == len(texts)
    assert all(got[i] == expected(i, t) for i, t in short.items())


@pytest.mark.parametrize("text", ["a " * 200_000, "lorem ipsum dolor " * 70_000, " ".join(str(i) for i in range(200_000))])
def test_very_long_texts(text):
    t0 = time.time()
    row = group_runs([7], [text.encode()], None)[0]
    assert time.time() - t0 < 60
    n = len(text.split())
    q = len(set(text.split()))
    assert row[1:5] == ((1, 0, n, q) if n >= 2 * q else (0, None, None, None))
