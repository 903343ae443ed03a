"""Ranked lexical search with geometric blocks in every posting list.

Documents are indexed in segments, as a task reads them.  In a segment each term's posting list
is clustered by document similarity: one document in ``BLOCK`` of the list stands for
a block, and every other joins the one its vector points to most (cosine of random projections of
the impact vectors).  A block keeps the greatest impact of every term over its documents.  For a
query, the sum of its weights times that summary bounds the score of every document of the
block; a block is skipped only if the bound is below a score that ``k`` documents reach (a list of up
to ``SMALL`` documents has no summary, and is opened), and a list is left closed only if it and all
lists of smaller bounds together stay below it.  So results are exact: blocks and projections decide
on the work alone.

The queries are a stated set, taken in blocks of bounded size.  Terms outside a block's
vocabulary add nothing to a bound or a score of its queries, so the index holds
every row but those terms only; document lengths and counts are of all terms.  Work: one pass
over the texts a block, no shuffle but of the best ``k`` of segments that reach the threshold.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import ctypes
import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.blocks import arrow_schema
from pitpanel.llm.hashing import LOWER, NOT_LETTERS, mix, word_hashes
from pitpanel.session import materialize

SEGMENT_DOCS = 1024
SEGMENT_BYTES = 8 << 20
BLOCK = 64                  # documents that a block is meant to hold
SMALL = 32                  # documents of a list that needs no summary
DIMENSIONS = 32             # of the projections
UNIT = 4096                 # summaries count impacts in such units, rounded up: a byte each
SEEDS = 32                  # segments that give the first thresholds
ITEMS = 4096                # queries of one block ...
ITEM_BYTES = 8 << 20        # ... and the text of one
VECTORS = "segment long, docs long, terms long, df array<long>, payload binary"
# rows of some MB, compressed already: a row group each, so that neither writer nor reader holds many
ROW_BY_ROW = {"parquet.block.size": 1 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
              "parquet.enable.dictionary": "false", "compression": "none"}
HITS = "item int, doc_id long, score long"


def freeze(*arrays: np.ndarray) -> bytes:
    """Compressed bytes of arrays: a type and a length for each, then their bytes, at multiples of 8."""
    parts = [b"".join(a.dtype.str.encode().ljust(8) + len(a).to_bytes(8, "little") for a in arrays)]
    for a in arrays:
        parts += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    raw = b"".join(parts)
    return len(arrays).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def thaw(payload: bytes) -> list[np.ndarray]:
    """Inverse of :func:`freeze`; the arrays are views of one buffer."""
    payload = memoryview(payload)
    n, size = (int.from_bytes(payload[i:i + 8], "little") for i in (0, 8))
    raw = pa.decompress(payload[16:], decompressed_size=size, codec="zstd")
    head, at, out = raw[:16 * n].to_pybytes(), 16 * n, []
    for i in range(0, 16 * n, 16):
        kind, length = np.dtype(head[i:i + 8].decode().strip()), int.from_bytes(head[i + 8:i + 16], "little")
        out.append(np.frombuffer(raw, kind, length, at))
        at += -(-length * kind.itemsize // 8) * 8
    return out


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of texts laid end to end, and where each text's terms begin."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    hashes, _, _, firsts = word_hashes(LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)], bounds, NOT_LETTERS)
    return hashes, firsts


def flat_ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``[lo, hi)``, one range after the other."""
    n = hi - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


# --- vectors -------------------------------------------------------------------------------------------

def _vectors_task(batches, vocabulary):
    words = vocabulary.value
    base, made = TaskContext.get().partitionId() << 32, 0
    schema = arrow_schema(VECTORS.replace(", df array<long>", "")).insert(3, pa.field("df", pa.list_(pa.int64())))
    done, seen, held = [], 0, 0

    def count(ids, data, bounds):
        """Term counts of some texts."""
        hashes, _, _, firsts = word_hashes(LOWER[data], bounds, NOT_LETTERS)
        n = np.diff(firsts)
        at = np.searchsorted(words, hashes)
        at[at == len(words)] = 0
        known = words[at] == hashes if len(words) else np.zeros(len(hashes), dtype=bool)
        keys, tf = np.unique(np.repeat(np.arange(len(ids)), n)[known] * max(len(words), 1) + at[known], return_counts=True)
        doc, term = np.divmod(keys, max(len(words), 1))
        done.append((ids, n, np.bincount(doc, minlength=len(ids)), term.astype(np.int32), tf.astype(np.int32)))

    def row():
        ids = [i for d in done for i in d[0]]
        n, entries, term, tf = (np.concatenate([d[k] for d in done]) for k in (1, 2, 3, 4))
        payload = freeze(np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is None for i in ids]), n,
                         np.concatenate([[0], np.cumsum(entries)]), term, tf)
        return pa.RecordBatch.from_arrays(
            [pa.array([base + made], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
             pa.array([np.bincount(term, minlength=len(words))], pa.list_(pa.int64())), pa.array([payload], pa.binary())], schema=schema)

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), b"")
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        i = 0
        while i < len(ids):
            # about 1 MB, but no more than the segment may still take (a text at least)
            room = min(1 << 20, SEGMENT_BYTES - held)
            j = max(i + 1, min(int(np.searchsorted(ends, ends[i] + room, side="right")) - 1, i + SEGMENT_DOCS - seen, len(ids)))
            count(ids[i:j], data[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
            seen, held = seen + j - i, held + int(ends[j] - ends[i])
            if seen >= SEGMENT_DOCS or held >= SEGMENT_BYTES:
                yield row()
                made, seen, held, done = made + 1, 0, 0, []
            i = j
    if seen:
        yield row()
    give_back()


def give_back() -> None:
    """Freed memory of a Python worker, which later stages use again, goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)                       # of the GNU library
    if trim:
        trim(0)


def count_vectors(docs: DataFrame, vocabulary: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of documents as counts of the vocabulary's terms (sorted hashes), written once."""
    words = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    return materialize(rows.mapInArrow(functools.partial(_vectors_task, vocabulary=words), VECTORS), "vectors", **ROW_BY_ROW)


def corpus_counts(vectors: DataFrame, n_words: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms, and document frequencies of the vocabulary (one number a term)."""
    total = vectors.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    df = np.zeros(n_words, dtype=np.int64)
    for r in vectors.select(F.posexplode("df").alias("w", "n")).where("n > 0").groupBy("w").agg(F.sum("n").alias("n")).collect():
        df[r["w"]] = r["n"]
    return total[0], total[1], df


# --- index ---------------------------------------------------------------------------------------------

class Segment:
    """Forward vectors, blocked posting lists and summaries of one segment.

    ``ids, null, ptr, term, impact``: documents and their terms' impacts; ``lists`` and ``blocks``: bounds of a
    term's blocks, and of a block's ``members``; ``best``: a term's greatest impact.  Summaries by list and
    term: ``cells`` are the bounds of a list's pairs; a pair has a ``word`` and ``count`` entries, an entry
    the block of the list it is in (``where``) and a ``value``.
    """

    FIELDS = ("ids", "null", "ptr", "term", "impact", "lists", "blocks", "members", "best", "cells", "word", "count", "where", "value")

    def __init__(self, payload: bytes):
        for name, a in zip(self.FIELDS, thaw(payload)):
            setattr(self, name, a)
        self.n_terms = len(self.best)
        self.entries = np.zeros(len(self.count) + 1, dtype=np.int64 if len(self.where) >> 31 else np.int32)
        np.cumsum(self.count, out=self.entries[1:])

    @staticmethod
    def build(payload: bytes, n_docs: int, n_all: int, n_terms: int) -> bytes:
        ids, null, n, ptr, term, tf = thaw(payload)
        m = 50 + 50 * n * n_docs // max(n_all, 1)
        owner = np.repeat(np.arange(len(ids)), np.diff(ptr))
        tf = tf.astype(np.int64)
        impact = (1_000_000_000 * tf // (1000 * tf + 20 * m[owner])).astype(np.int32)
        units = (-(-impact // UNIT)).astype(np.uint8)
        points = _project(term, impact, ptr, n_terms)

        order = np.argsort(term, kind="stable")
        list_ptr = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])
        best = np.zeros(n_terms, dtype=np.int64)
        np.maximum.at(best, term, impact)
        lists, cells, sizes, members, words, counts, where, value = [0], [0], [], [], [], [], [], []
        small = np.uint16 if n_terms < 1 << 16 else np.uint32
        for t in range(n_terms):
            docs = owner[order[list_ptr[t]:list_ptr[t + 1]]]
            if not len(docs):
                lists.append(lists[-1])
                cells.append(cells[-1])
                continue
            block = _cluster(points[docs])
            k = int(block.max()) + 1
            members.append(docs[np.argsort(block, kind="stable")])
            sizes.append(np.bincount(block, minlength=k))
            lists.append(lists[-1] + k)
            if len(docs) <= SMALL:
                cells.append(cells[-1])
                continue
            entries = flat_ranges(ptr[docs], ptr[docs + 1])
            top = np.zeros(n_terms * k, dtype=np.uint8)                     # the summaries of this list alone
            cell = term[entries].astype(np.int64) * k + np.repeat(block, ptr[docs + 1] - ptr[docs])
            np.maximum.at(top, cell, units[entries])
            cell = np.flatnonzero(top)
            word = cell // k
            first = np.flatnonzero(np.diff(word, prepend=-1))
            cells.append(cells[-1] + len(first))
            words.append(word[first].astype(small))
            counts.append(np.diff(np.append(first, len(word))).astype(np.uint8 if k < 1 << 8 else np.uint32))
            where.append((cell - word * k).astype(np.uint8 if k <= 1 << 8 else np.uint32))
            value.append(top[cell])
        cat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, dtype=kind)
        blocks = np.concatenate([[0], np.cumsum(cat(sizes, np.int64))]).astype(np.int64)
        return freeze(ids, null, ptr, term, impact, np.array(lists, dtype=np.int64), blocks, cat(members, np.int64).astype(np.int32), best,
                      np.array(cells, dtype=np.int64), cat(words, small), cat(counts, np.uint8), cat(where, np.uint8), cat(value, np.uint8))

    def bounds(self, terms: np.ndarray, weights: np.ndarray):
        """Block numbers of the query's lists, and the bound of each."""
        lo, hi = self.lists[terms], self.lists[terms + 1]
        blocks = flat_ranges(lo, hi)
        shift = np.cumsum(hi - lo) - (hi - lo)
        whole = int((weights * self.best[terms]).sum())
        bound = np.zeros(len(blocks), dtype=np.int64)
        order = np.argsort(terms)
        sought, paid = terms[order], weights[order]
        pairs, weight, base = [], [], []
        for t, at, n in zip(terms.tolist(), shift.tolist(), (hi - lo).tolist()):
            a, b = self.cells[t], self.cells[t + 1]
            if a == b:
                bound[at:at + n] = whole                                        # no summary: any score the query can have
                continue
            i = np.searchsorted(self.word[a:b], sought)
            i[i == b - a] = 0
            hit = np.flatnonzero(self.word[a + i] == sought)
            pairs.append(a + i[hit])
            weight.append(paid[hit])
            base.append(np.full(len(hit), at))
        if pairs:
            pairs, weight, base = (np.concatenate(x) for x in (pairs, weight, base))
            a, b = self.entries[pairs], self.entries[pairs + 1]
            entries = flat_ranges(a, b)
            part = np.repeat(weight, b - a) * (self.value[entries].astype(np.int64) * UNIT)
            bound += np.bincount(np.repeat(base, b - a) + self.where[entries], weights=part, minlength=len(blocks)).astype(np.int64)
        return blocks, bound                                                    # sums below 2^53 are exact

    def documents(self, blocks: np.ndarray) -> np.ndarray:
        return np.unique(self.members[flat_ranges(self.blocks[blocks], self.blocks[blocks + 1])])

    def scores(self, docs: np.ndarray, by_term: np.ndarray) -> np.ndarray:
        """Exact scores; ``by_term`` holds the query's weights, zero for other terms."""
        if not len(docs):
            return np.zeros(0, dtype=np.int64)
        entries = flat_ranges(self.ptr[docs], self.ptr[docs + 1])
        parts = by_term[self.term[entries]] * self.impact[entries].astype(np.int64)
        return np.add.reduceat(parts, np.cumsum(self.ptr[docs + 1] - self.ptr[docs]) - (self.ptr[docs + 1] - self.ptr[docs]))

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int, k: int, seed: bool):
        """The segment's best ``k`` documents with a score of ``least`` or more (and above 0): numbers and
        scores.  With ``seed``, only of the blocks with the greatest bounds."""
        by_term = np.zeros(self.n_terms, dtype=np.int64)
        by_term[terms] = weights
        least = max(least, 1)
        full = weights * self.best[terms]
        order = np.argsort(-full, kind="stable")
        rest = np.cumsum(full[order][::-1])[::-1]                               # of a list and all after it
        terms, weights = terms[order], weights[order]
        blocks, bound = self.bounds(terms, weights)
        size = self.blocks[blocks + 1] - self.blocks[blocks]
        by_bound = np.argsort(-bound, kind="stable")
        some = by_bound[:int(np.searchsorted(np.cumsum(size[by_bound]), 2 * k)) + 1]
        docs = self.documents(blocks[some])
        scores = self.scores(docs, by_term)
        if not seed:
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
            open_lists = int((rest >= least).sum())                             # a prefix: sums fall
            in_open = np.repeat(np.arange(len(terms)), self.lists[terms + 1] - self.lists[terms]) < open_lists
            mine = in_open & (bound >= least)
            mine[some] = False
            more = np.setdiff1d(self.documents(blocks[mine]), docs, assume_unique=True)
            docs, scores = np.concatenate([docs, more]), np.concatenate([scores, self.scores(more, by_term)])
        keep = scores >= least
        docs, scores = docs[keep], scores[keep]
        order = np.lexsort((self.ids[docs], self.null[docs], -scores))[:k]
        return docs[order], scores[order]


def _project(term, impact, ptr, n_terms: int) -> np.ndarray:
    """Unit vectors: random signs of the terms, summed by impact, for every document."""
    seeds = mix(np.arange(1, n_terms + 1, dtype=np.uint64))
    signs = ((seeds[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    points = np.zeros((len(ptr) - 1, DIMENSIONS), dtype=np.float32)
    filled = np.flatnonzero(np.diff(ptr))
    for i in range(0, len(filled), 1024):
        d = filled[i:i + 1024]
        lo, hi = ptr[d[0]], ptr[d[-1] + 1]
        points[d] = np.add.reduceat(signs[term[lo:hi]] * impact[lo:hi, None].astype(np.float32), ptr[d] - lo, axis=0)
    return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)


def _cluster(points: np.ndarray) -> np.ndarray:
    """Block number of each point, blocks without a point left out."""
    n = len(points)
    if n <= BLOCK:
        return np.zeros(n, dtype=np.int64)
    heads = points[np.linspace(0, n - 1, -(-n // BLOCK)).astype(np.int64)].T
    block = np.concatenate([np.argmax(points[i:i + 4096] @ heads, axis=1) for i in range(0, n, 4096)])
    return np.unique(block, return_inverse=True)[1]


def _index_task(batches, n_docs: int, n_all: int, n_terms: int):
    for batch in batches:
        for segment, payload in zip(*batch.columns):
            out = Segment.build(payload.as_buffer(), n_docs, n_all, n_terms)
            yield pa.RecordBatch.from_arrays([pa.array([segment.as_py()], pa.int64()), pa.array([out], pa.binary())], names=["segment", "payload"])
            del out
            give_back()


def build_index(vectors: DataFrame, n_docs: int, n_all: int, n_terms: int) -> DataFrame:
    """Blocked posting lists and summaries of every segment, written once."""
    task = functools.partial(_index_task, n_docs=n_docs, n_all=n_all, n_terms=n_terms)
    return materialize(vectors.select("segment", "payload").mapInArrow(task, "segment long, payload binary"), "ranking-index", **ROW_BY_ROW)


# --- search --------------------------------------------------------------------------------------------

def _search_task(batches, queries, least, k: int, seed: bool):
    schema = arrow_schema(HITS)
    for batch in batches:
        for payload in batch.column(0):
            segment = Segment(payload.as_buffer())
            items, ids, scores = [], [], []
            for item, (terms, weights) in enumerate(queries.value):
                if not len(terms):
                    continue
                d, s = segment.search(terms, weights, least[item], k, seed)
                items.append(np.full(len(d), item, dtype=np.int32))
                ids += [None if z else i for i, z in zip(segment.ids[d].tolist(), segment.null[d].tolist())]
                scores.append(s)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items), pa.int32()), pa.array(ids, pa.int64()),
                                                  pa.array(np.concatenate(scores), pa.int64())], schema=schema)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every item; Spark keeps each task's best before the shuffle."""
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search_index(index: DataFrame, queries: list, k: int, n_segments: int) -> DataFrame:
    """``item, rank, doc_id, score`` of the best ``k`` documents of each query (terms, weights).

    The best blocks of at most about ``SEEDS`` segments, spread over the index, give each query a score that ``k``
    documents reach; every segment is then searched for what reaches it.
    """
    held = index.sparkSession.sparkContext.broadcast(queries)
    run = lambda rows, least, seed: rows.select("payload").mapInArrow(
        functools.partial(_search_task, queries=held, least=least, k=k, seed=seed), HITS)
    some = index.where(F.pmod(F.xxhash64("segment"), F.lit(max(1, n_segments // SEEDS))) == 0)
    first = _best(run(some, [0] * len(queries), True), k).groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("s"))
    least = [0] * len(queries)
    for r in first.where(F.col("n") == k).collect():                           # one number a query
        least[r["item"]] = r["s"]
    return _best(run(index, least, False), k)


def _blocks_of_items(items: DataFrame, item_id: str, text: str):
    """Lists of (id, text) of bounded size; a longer text is a list of its own."""
    block, size = [], 0
    for r in items.select(F.col(item_id), F.col(text)).toLocalIterator():
        raw = (r[1] or "").encode()
        if block and (len(block) >= ITEMS or size + len(raw) > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append((r[0], raw))
        size += len(raw)
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of every item with a score above 0: ``item_id, rank, doc_id, score``.

    Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.  A term's weight is
    ``floor(1000 ln((2N+2)/(2df+1)))``, its impact in a document ``10^9 tf div (1000 tf + 20 m)`` with
    ``m = 50 + 50 n N div L``; a score sums weight times impact over the item's different terms.  Equal scores
    are ranked by ascending ``doc_id``, null ids last.

    Null and empty texts have no terms (and are found by no item; an item without terms finds nothing); repeated
    documents and items count and are answered row by row; empty tables give no rows; further columns are ignored.
    A very long text is counted whole in one task, and is one vector.
    """
    spark = docs.sparkSession
    answers = []
    for block in _blocks_of_items(items, item_id, item_text):
        hashes, firsts = term_hashes([raw for _, raw in block])
        words = np.unique(hashes)
        vectors = count_vectors(docs, words, doc_id, text)
        n_docs, n_all, df = corpus_counts(vectors, len(words))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
        queries = []
        for a, b in zip(firsts, firsts[1:]):
            terms = np.searchsorted(words, np.unique(hashes[a:b]))
            terms = terms[(df[terms] > 0) & (weight[terms] > 0)]
            queries.append((terms, weight[terms]))
        index = build_index(vectors, n_docs, n_all, len(words))
        found = search_index(index, queries, k, vectors.count())
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item int, item_id {items.schema[item_id].dataType.simpleString()}")
        answers.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not answers:
        return spark.createDataFrame([], f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionAll, answers)
