"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``d`` bits have a middle within ``d / 2`` of both, so if each
emits every variant in its ball of half the radius, near pairs collide on a variant.
Over 64 bits and ``d = 4`` a ball has 2,081 variants.  Two steps keep that bounded:

1. Of any ``d`` differing bits one 32-bit half holds ``d / 2`` at most.  Every
   fingerprint emits the balls of half *that* radius around each of its halves (2 x 33
   variants), these are dealt by variant, and colliding pairs are verified in full.
2. A variant shared by more than ``SMALL`` fingerprints is not paired off.  All of its
   fingerprints emit their full balls instead.  Two that collide there are within
   ``d`` of each other whatever the number, so a chain through the variant's
   members links them all, at one link each.

Both partners of a near pair meet on the same variant in step 1, so either it is
verified there or both go on to step 2: no link between components is lost.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import blocks as B
from pitpanel.llm.components import connected_components
from pitpanel.llm.hashing import LOWER, mix
from pitpanel.session import materialize

U = np.uint64
SMALL = 64
VARIANTS_PER_PART = 1 << 20
LOWER_TABLE = LOWER.tobytes()


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included."""
    words = text.translate(LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, stops)], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, bits`` (the fingerprint as a signed long) for every row."""
    def batches(rows):
        for batch in rows:
            prints = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, dtype=U).view(np.int64))], names=["doc_id", "bits"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(batches, "doc_id long, bits long")


def ball(bits: int, radius: int) -> np.ndarray:
    """Masks of all variants within ``radius`` bits."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=U)


def spread_variants(rows, variants, per_batch: int, parts: int):
    """Deal the variants of fingerprints by variant; a payload is the variants, the
    positions of their fingerprints, then the fingerprints and nodes of the batch."""
    schema = B.arrow_schema("part int, block long, n long, m long, payload binary")
    made = TaskContext.get().partitionId() << 32
    for batch in rows:
        bits, nodes = (batch.column(i).to_numpy() for i in (0, 1))
        for at in range(0, len(bits), per_batch):
            p = bits[at:at + per_batch].view(U)
            node = nodes[at:at + per_batch]
            keys = variants(p)
            owner = np.repeat(np.arange(len(p), dtype=np.uint32), keys.shape[1])
            keys = keys.ravel()
            part = B.part_of(mix(keys), parts)
            order = np.lexsort((keys, part))
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            lines = []
            for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
                mine = order[lo:hi]
                used, index = np.unique(owner[mine], return_inverse=True)
                lines.append((int(part[mine[0]]), made, len(mine), len(used), B.pack(keys[mine], index.astype(np.uint32), p[used], node[used])))
            made += 1
            yield from B.table(lines, "part int, block long, n long, m long, payload binary").cast(schema).to_batches()


def gather(rows):
    """Variants in order with the fingerprint and node of each."""
    keys, prints, nodes = [], [], []
    for r in rows:
        raw = pa.decompress(r["payload"], decompressed_size=12 * r["n"] + 16 * r["m"], codec="zstd", asbytes=True)
        n, m = r["n"], r["m"]
        index = np.frombuffer(raw, np.uint32, n, 8 * n)
        keys.append(np.frombuffer(raw, U, n))
        prints.append(np.frombuffer(raw, U, m, 12 * n)[index])
        nodes.append(np.frombuffer(raw, np.int64, m, 12 * n + 8 * m)[index])
    keys, prints, nodes = (np.concatenate(x) for x in (keys, prints, nodes))
    order = np.lexsort((nodes, keys))
    return keys[order], prints[order], nodes[order]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple]:
    """Links (node, least node) with the same components as the links given."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(ids)))
    return list(zip(ids[label[away]].tolist(), ids[away].tolist()))


def verified(rows, distance: int, small: int):
    """Step 1 for a range of variants: verified links, and the nodes of crowded variants."""
    keys, prints, nodes = gather(rows)
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ U(1)) != 0)
    size = np.diff(np.append(first, len(keys)))
    crowded = np.repeat(size > small, size)
    hot = np.unique(np.stack([prints[crowded].view(np.int64), nodes[crowded]]), axis=1)
    keys, prints, nodes = keys[~crowded], prints[~crowded], nodes[~crowded]
    a, b = [], []
    for s in range(1, small):
        at = np.flatnonzero(keys[s:] == keys[:-s])
        if not len(at):
            break
        at = at[np.bitwise_count(prints[at + s] ^ prints[at]) <= distance]
        a.append(nodes[at])
        b.append(nodes[at + s])
    links = forest(np.concatenate(a), np.concatenate(b)) if a else []
    return [("link", x, y) for x, y in links] + [("hot", x, y) for x, y in hot.T.tolist()]


def chained(rows, distance: int):
    """Step 2 for a range of variants: neighbours on a variant, verified."""
    keys, prints, nodes = gather(rows)
    at = np.flatnonzero(keys[1:] == keys[:-1])
    at = at[np.bitwise_count(prints[at + 1] ^ prints[at]) <= distance]
    return [("link", x, y) for x, y in forest(nodes[at], nodes[at + 1])] if len(at) else []


def half_variants(prints, masks):
    """Variants of the low and of the high 32 bits; the top bit of a key tells which."""
    low, high = prints & U(0xFFFFFFFF), prints >> U(32)
    return np.concatenate([low[:, None] ^ masks, (high[:, None] ^ masks) | U(1 << 63)], axis=1)


def full_variants(prints, masks):
    return prints[:, None] ^ masks


def near_links(nodes: DataFrame, distance: int = 4, small: int = SMALL) -> DataFrame:
    """Links ``a, b`` between nodes (``bits, node``) that join exactly the fingerprints
    that chains of differences of at most ``distance`` bits join."""
    schema = "part int, block long, n long, m long, payload binary"
    n = nodes.count()

    def step(rows, variants, masks, per_batch, parts, reduce):
        dealt = rows.select("bits", "node").mapInArrow(
            functools.partial(spread_variants, variants=functools.partial(variants, masks=masks), per_batch=per_batch, parts=parts), schema)
        return B.reduce_parts(dealt, reduce, "what string, a long, b long")

    half = ball(32, distance // 4)
    met = materialize(step(nodes, half_variants, half, 10_000, max(16, -(-n * 2 * len(half) // VARIANTS_PER_PART)),
                           functools.partial(verified, distance=distance, small=small)), "simhash-halves")
    links = met.where("what = 'link'").select("a", "b")
    hot = materialize(met.where("what = 'hot'").select(F.col("a").alias("bits"), F.col("b").alias("node")).distinct(), "simhash-hot")
    n_hot = hot.count()
    if not n_hot:
        return links
    full = ball(64, distance // 2)
    return links.union(step(hot, full_variants, full, 500, max(16, -(-n_hot * len(full) // VARIANTS_PER_PART)),
                            functools.partial(chained, distance=distance)).select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, small: int = SMALL,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    The component is the smallest ``doc_id`` that chains of fingerprints at
    ``distance`` bits or fewer (a multiple of 4) reach.

    Null, empty and blank texts have fingerprint zero and are linked like any other.
    Repeated rows have one fingerprint; rows that share a ``doc_id`` count as one
    document.  A null ``doc_id`` takes part, but never names a component: one that
    holds nothing else has a null ``component_id``.  Ids may be any long.  An empty table
    gives no rows; other columns are ignored.

    Fingerprints themselves are the nodes of the search; the least id of a component is
    then found by a partially aggregated group-by over one row per fingerprint, and joined back.
    """
    if distance % 2 or (distance // 2) % 2:
        raise ValueError("distance must be a multiple of 4, so that each half has a whole middle")
    prints = materialize(fingerprints(docs, shingle, doc_id, text), "simhash")
    nodes = materialize(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = connected_components(near_links(nodes.select("bits", F.col("bits").alias("node")), distance, small).distinct())
    rooted = materialize(nodes.join(roots, nodes["bits"] == roots["node"], "left").select("bits", "least", F.coalesce("root", "bits").alias("root")),
                         "simhash-rooted")
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    out = prints.join(rooted.join(component, "root").select("bits", "component_id"), "bits")
    return out.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, small: int = SMALL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that have the least ``doc_id`` of their
    component (null ids last; one row of equal ids)."""
    row = B.free_name(docs, "_row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    member = near_duplicates(numbered, shingle, distance, small, row, text)
    ids = numbered.select(F.col(row).alias("doc_id"), F.col(doc_id).alias("_id"))
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("doc_id"))
    kept = member.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias(row))
    return numbered.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
