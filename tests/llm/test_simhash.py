"""SimHash components against brute force over all pairs."""

import random

import pytest
import xxhash

from pitpanel.llm.components import connected_components
from pitpanel.llm.simhash import fingerprint, near_duplicates, near_links


def plain(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints, distance=4):
    """prints: list of (id, bits); the least id reachable for each."""
    root = {}
    for i, (d, p) in enumerate(prints):
        if i in root:
            continue
        todo, seen = [i], {i}
        while todo:
            x = todo.pop()
            for j, (_, q) in enumerate(prints):
                if j not in seen and bin(prints[x][1] ^ q).count("1") <= distance:
                    seen.add(j)
                    todo.append(j)
        ids = [prints[j][0] for j in seen if prints[j][0] is not None]
        for j in seen:
            root[j] = min(ids, default=None)
    return sorted(((d, f"{p:016x}", root[i]) for i, (d, p) in enumerate(prints)), key=str)


def test_fingerprint_matches_definition():
    rng = random.Random(0)
    for n in (0, 1, 2, 3, 4, 5, 6, 50):
        t = "\t\n ".join(rng.choice(["The", "É", "fox", "a1", " x"]) for _ in range(n))
        assert fingerprint(t.encode()) == plain(t)


def test_documents_match_brute_force(spark):
    rng = random.Random(1)
    base = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(200)) for _ in range(8)]
    rows = []
    for i in range(120):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "zz"
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (None, " "), (202, rows[3][1].upper()), (None, rows[5][1]), (None, "only this text here"), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string").repartition(5)
    want = brute([(d, plain(t)) for d, t in rows])
    for small in (64, 2):
        got = sorted((tuple(r) for r in near_duplicates(df, small=small).collect()), key=str)
        assert got == want


def test_any_id_names_a_component(spark):
    """Ids of the whole range of longs, negative ones included, and near texts of which none has an id."""
    words = [f"w{i}" for i in range(300)]
    near = [" ".join(words), " ".join([*words[:150], "zz", *words[151:]])]
    texts = [(2 ** 62 + 9, "far off one"), (2 ** 62 + 5, "far off one"), (2 ** 63 - 1, None), (-2 ** 63, "quite another"), (7, "quite another"),
             (2 ** 63 - 2, near[0]), (2 ** 63 - 3, near[1]), (None, near[0]), (None, "without an id"), (None, "without an id")]
    rows = [(d, t) for d, t in texts]
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute([(d, plain(t)) for d, t in rows])
    assert [c for d, _, c in got if d in (2 ** 62 + 5, 2 ** 62 + 9)] == [2 ** 62 + 5] * 2


@pytest.mark.parametrize("small", [2, 8, 64])
def test_links_join_what_brute_force_joins(spark, small):
    rng = random.Random(small)
    prints = []
    for _ in range(40):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.append(p)
    prints = list(dict.fromkeys(prints))
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "bits long, node long").repartition(4)
    roots = {r.node: r.root for r in connected_components(near_links(nodes, small=small)).collect()}
    got = sorted(((i, f"{p:016x}", roots.get(i, i)) for i, p in enumerate(prints)), key=str)
    assert got == brute(list(enumerate(prints)))


def test_long_chain_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 999)], "a long, b long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 301)} | {1000: 999}
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
