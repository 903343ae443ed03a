"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages and weighted by TF-IDF, with document frequencies
counted over the distinct texts of the whole corpus: copies don't make a word common.
A randomised SVD (range finder, power iterations, all products formed by Spark over the
passages) gives latent spaces of ``rank`` dimensions; up to ``CROWD`` times as many
passages share one.  Coordinates are divided by the roots of their singular values, so that the
directions which all passages of a language share don't drown the others.  Windows of every document, as long
as the passages they are compared with, are projected into each space, and items at a cosine (of the
projected vectors) of ``least_cosine`` or more are candidates.  A candidate stands if the window's full TF-IDF vector
is not far from the passage's either (``least_full``), the longest common subsequence of words with the
item near that window covers ``least_lcs`` of the item, and ``least_answer`` of the rarer half of the item's
words (its answer) are there.

The benchmark is the query set.  It is worked off in blocks of ``block_items`` items and
``SPACES`` latent spaces at most, so what is broadcast (vocabulary, weights, latent vectors)
is bounded by these; work grows with documents times spaces.  The corpus is never sampled; for the document
frequencies the distinct vocabulary words of each text, four bytes each, are shuffled once a block.

Null and empty texts hold nothing.  A very long text is searched whole in one task, in parts of its
windows; a very long item is cut into passages that share spaces like those of other items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.hashing import LOWER, NOT_LETTERS, Lookup, word_hashes

U = np.uint64
PASSAGE, STRIDE = 48, 24
CELL = 12               # words; a window is 2 to 4 cells
CROWD = 4               # passages of a latent space for each of its dimensions
COMMON = 0.2            # words in more than this share of texts carry little weight
GROUP_BYTES = 1 << 20
SPACES = 16             # latent spaces that one pass over the documents searches
MATCH_SCHEMA = "doc_id long, item_id long, cosine double, lcs double, answer double, start long"


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts, end to end, and each text's first word."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    keys, _, _, firsts = word_hashes(LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)], bounds, NOT_LETTERS)
    return keys, firsts


def groups(texts: list[bytes]):
    """Index ranges of texts of about ``GROUP_BYTES`` together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > GROUP_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def passage_starts(n: int) -> list[int]:
    """First words of the passages of a text of ``n`` words; the last ends with it."""
    return [*range(0, max(n - PASSAGE, 0), STRIDE), max(n - PASSAGE, 0)] if n else []


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming."""
    where: dict = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = where.get(x, 0)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Space:
    """The latent space of some items' passages."""

    words: np.ndarray               # places in the vocabulary, sorted
    basis: np.ndarray               # words x rank: right singular vectors over singular values, times idf
    latent: np.ndarray              # passages of items x rank, unit length
    owner: np.ndarray               # item of each passage
    cells: np.ndarray               # cells of the windows that each passage is compared with
    rows: list                      # (places in the vocabulary, unit TF-IDF values) of each passage


@dataclass
class Index:
    """What a task needs to search one block of benchmark items."""

    vocabulary: np.ndarray          # word hashes, sorted
    idf: np.ndarray                 # of the vocabulary
    top_idf: float                  # of a word outside of it
    spaces: list[Space]
    items: list                     # (item id, word hashes, answer words) of each item
    lookup: Lookup | None = None

    def __getstate__(self):
        return self.__dict__ | {"lookup": None}

    def positions(self, keys: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary; -1 for others."""
        if self.lookup is None:
            self.lookup = Lookup(self.vocabulary, np.arange(len(self.vocabulary), dtype=np.int64))
        at, known = self.lookup.get(keys)
        return np.where(known, at, -1)

    def candidates(self, keys, firsts, least_cosine, least_full):
        """(text, first word, item, cosine) for windows near an item."""
        at = self.positions(keys)
        idf = np.where(at >= 0, self.idf[at], self.top_idf)
        squares = np.zeros(len(idf) + 1)
        np.cumsum(idf * idf, out=squares[1:])
        n_cells = -(-np.diff(firsts) // CELL)
        ends = np.cumsum(n_cells)
        text = np.repeat(np.arange(len(n_cells)), n_cells)
        start = firsts[text] + (np.arange(len(text)) - (ends - n_cells)[text]) * CELL
        cell = (ends - n_cells).repeat(np.diff(firsts)) + (np.arange(len(keys)) - np.repeat(firsts[:-1], np.diff(firsts))) // CELL
        out = []
        for space in self.spaces:
            row = np.full(len(self.vocabulary) + 1, -1)
            row[space.words] = np.arange(len(space.words))
            row = row[at]                               # the last entry is that of unknown words
            known = np.flatnonzero(row >= 0)
            if not len(known):
                continue
            sums = np.zeros((len(text) + 3, space.basis.shape[1]), dtype=np.float32)
            new = np.flatnonzero(np.diff(cell[known], prepend=-1))
            for a in range(0, len(new), 4096):
                lo, hi = new[a], new[a + 4096] if a + 4096 < len(new) else len(known)
                sums[cell[known[new[a:a + 4096]]]] = np.add.reduceat(space.basis[row[known[lo:hi]]], new[a:a + 4096] - lo)
            for width in np.unique(space.cells).tolist():
                mine = np.flatnonzero(space.cells == width)
                latent = space.latent[mine].T
                i = np.arange(len(text))
                if width == 4:                          # long windows start at every second cell
                    i = i[(i - (ends - n_cells)[text]) % 2 == 0]
                for a in range(0, len(i), 4096):
                    w = i[a:a + 4096]
                    window = sums[w].copy()
                    for k in range(1, width):
                        inside = w + k < ends[text[w]]
                        window[inside] += sums[w[inside] + k]
                    norm = np.sqrt(np.einsum("ij,ij->i", window, window))
                    cosine = window @ latent
                    p, q = np.nonzero(cosine >= (least_cosine * np.maximum(norm, 1e-9))[:, None])
                    first = start[w[p]]
                    last = np.minimum(first + width * CELL, firsts[text[w[p]] + 1])
                    full = np.sqrt(squares[last] - squares[first])
                    for j, (a_, b_, k) in enumerate(zip(first.tolist(), last.tolist(), mine[q].tolist())):
                        columns, values = space.rows[k]
                        place = np.minimum(np.searchsorted(columns, at[a_:b_]), len(columns) - 1)
                        dot = (idf[a_:b_] * values[place])[columns[place] == at[a_:b_]].sum()
                        if dot >= least_full * full[j]:
                            out.append((int(text[w[p[j]]]), a_, int(space.owner[k]), float(cosine[p[j], q[j]] / norm[p[j]])))
        return out

    def matches(self, texts: list[bytes], least_cosine, least_full, least_lcs, least_answer):
        """For each text, its items: {item: (cosine, lcs share, answer share, first word)}."""
        found: list[dict] = [{} for _ in texts]
        for a, b in groups(texts):
            keys, firsts = words_of(texts[a:b])
            for text, start, item, cosine in self.candidates(keys, firsts, least_cosine, least_full):
                _, words, answer = self.items[item]
                n = len(words)
                # the item may begin before the passage or end after it
                lo = max(int(firsts[text]), start - n)
                hi = min(int(firsts[text + 1]), start + PASSAGE + n)
                width = n + n // 3 + 1
                if np.isin(words, keys[lo:hi]).mean() < least_lcs:               # no subsequence can be long enough
                    continue
                for w in range(lo, max(hi - width, lo) + 1, max(1, n // 6)):
                    window = keys[w:min(w + width, hi)]
                    share = lcs_length(words, window) / n
                    if share < least_lcs:
                        continue
                    there = float(np.isin(answer, window).mean())
                    if there >= least_answer and share > found[a + text].get(item, (0, 0))[1]:
                        found[a + text][item] = (cosine, share, there, w - int(firsts[text]))
        return found


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray, text: str) -> tuple[np.ndarray, int]:
    """Distinct texts that hold each word, over all documents, and the number of these."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def places(batches):
        """The words of texts that the task has not just met, four bytes each."""
        table, met = Lookup(shared.value, np.arange(len(shared.value), dtype=np.int64)), set()
        for batch in batches:
            marks, texts = [], []
            for mark, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if mark not in met:
                    met.add(mark)
                    marks.append(mark)
                    texts.append(t)
            if len(met) > 1 << 17:
                met.clear()
            held = []
            for a, b in groups(texts):
                keys, firsts = words_of(texts[a:b])
                at, known = table.get(keys)
                doc = np.repeat(np.arange(b - a), np.diff(firsts))[known]
                pairs = np.unique(doc * len(shared.value) + at[known])
                cuts = np.searchsorted(pairs, np.arange(1, b - a) * len(shared.value))
                held += [x.tobytes() for x in np.split((pairs % len(shared.value)).astype(np.int32), cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(held, pa.binary())], names=["mark", "words"])

    def count(batches):
        """One row for a task: its counts are as many as the vocabulary.  Rows come by mark."""
        df, n, last = np.zeros(len(shared.value), dtype=np.int64), 0, None
        for batch in batches:
            words = []
            for mark, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if mark != last:
                    words.append(held)
                last = mark
            n += len(words)
            df += np.bincount(np.frombuffer(b"".join(words), dtype=np.int32), minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["word", "n"])

    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    texts = docs.select(F.xxhash64(body).alias("mark"), body.alias("text")).mapInArrow(places, "mark long, words binary")
    rows = texts.repartition("mark").sortWithinPartitions("mark").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(rows["word"].to_pylist(), rows["n"].to_pylist()))
    n = counts.pop(-1, 0)
    out = np.zeros(len(vocabulary))
    for w, c in counts.items():
        out[w] = c
    return out, n


def randomised_svd(spark, rows: list[tuple], n_columns: int, rank: int, power: int = 2, spare: int = 10, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (columns) and singular values of a sparse matrix whose rows are (columns, values).

    Each product ``A' A X`` is formed by Spark: a task multiplies its rows, the partial
    products are summed by ranges of columns.  The driver holds ``n_columns`` x rank.
    """
    rank = max(1, min(rank, len(rows), n_columns))
    width = min(rank + spare, len(rows), n_columns)
    matrix = spark.createDataFrame([(c.tolist(), v.tolist()) for c, v in rows], "at array<long>, value array<double>").repartition(8)
    slices = max(1, min(64, n_columns // 256))

    def product(x):
        shared = spark.sparkContext.broadcast(x)

        def partial(batches):
            out = np.zeros_like(shared.value)
            for batch in batches:
                for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    out[at] += np.outer(value, np.array(value) @ shared.value[at])
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int64()), pa.array([np.ascontiguousarray(s).tobytes() for s in np.array_split(out, slices)], pa.binary())], names=["slice", "block"])

        def add(key, table):
            total = sum(np.frombuffer(b, dtype=float) for b in table["block"].to_pylist())
            return pa.table({"slice": [key[0].as_py()], "block": [total.tobytes()]})

        done = matrix.mapInArrow(partial, "slice long, block binary").groupBy("slice").applyInArrow(add, "slice long, block binary").collect()
        return np.concatenate([np.frombuffer(r["block"], dtype=float) for r in sorted(done, key=lambda r: r["slice"])]).reshape(n_columns, -1)

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_columns, width)))[0]
    for _ in range(power):
        basis = np.linalg.qr(product(basis))[0]
    # Rayleigh-Ritz: rotate the basis to the leading directions
    values, turn = np.linalg.eigh(basis.T @ product(basis))
    first = np.argsort(values)[::-1][:rank]
    first = first[values[first] > 1e-9 * values.max()]
    return basis @ turn[:, first], np.sqrt(values[first])


def latent_space(spark, rows: list[tuple], owner: list[int], cells: list[int], idf: np.ndarray, rank: int) -> Space:
    """The space of ``rank`` dimensions of ``rows``, passages as (places in the vocabulary, unit values)."""
    full = rows
    words = np.unique(np.concatenate([c for c, _ in rows]))
    rows = [(np.searchsorted(words, c), v) for c, v in rows]
    vectors, values = randomised_svd(spark, rows, len(words), rank)
    space = vectors / np.sqrt(values)
    latent = np.stack([v @ space[c] for c, v in rows])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return Space(words, (space * idf[words][:, None]).astype(np.float32), latent.astype(np.float32), np.array(owner), np.array(cells), full)


def build_index(docs: DataFrame, words: list[tuple], parts: list[list[int]], rank: int, text: str) -> Index | None:
    """Index of benchmark items, (id, word hashes) each; the items of a part share a space.
    None if no document has a word with a weight."""
    vocabulary = np.unique(np.concatenate([w for _, w in words]))
    df, n = document_frequencies(docs, vocabulary, text)
    if not n:
        return None
    idf = np.log((n + 1) / (df + 1)) + 1
    idf[df > max(COMMON * n, 20)] -= 0.9                # at least 0.1: every passage is indexed
    top = float(np.log(n + 1) + 1)
    spaces = []
    for part in parts:
        rows, owner, cells = [], [], []
        for k in part:
            at = np.searchsorted(vocabulary, words[k][1])
            for s in passage_starts(len(at)):
                columns, count = np.unique(at[s:s + PASSAGE], return_counts=True)
                value = count * idf[columns]
                if value.any():
                    rows.append((columns[value > 0], value[value > 0] / np.linalg.norm(value)))
                    owner.append(k)
                    cells.append(min(-(-len(at) // CELL) + 1, PASSAGE // CELL))
        if rows:
            spaces.append(latent_space(docs.sparkSession, rows, owner, cells, idf, rank))
    if not spaces:
        return None
    answers = []
    for i, w in words:
        distinct = np.unique(w)
        rarest = distinct[np.argsort(-idf[np.searchsorted(vocabulary, distinct)], kind="stable")][:-(-len(distinct) // 2)]
        answers.append((i, w, rarest))
    return Index(vocabulary, idf, top, spaces, answers)


def spaces_of(words: list[tuple], rank: int):
    """Items, (id, word hashes) each, with the parts of them that share a latent space: up to
    ``SPACES`` parts, of up to ``CROWD * rank`` passages or one item."""
    chosen, parts, size = [], [], 0
    for item in words:
        n = len(passage_starts(len(item[1])))
        if not parts or size + n > CROWD * rank:
            if len(parts) == SPACES:
                yield chosen, parts
                chosen, parts = [], []
            parts.append([])
            size = 0
        parts[-1].append(len(chosen))
        chosen.append(item)
        size += n
    if chosen:
        yield chosen, parts


def indexes(docs: DataFrame, benchmark: DataFrame, rank: int, block_items: int, text: str):
    """An index, broadcast, for every block of benchmark items (several for long items)."""
    spark = docs.sparkSession
    n = benchmark.count()
    numbered = benchmark.select("item_id", F.col("text").cast("binary").alias("text"), F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-n // block_items)))).alias("block"))
    for b in range(max(1, -(-n // block_items))):
        items = [(r["item_id"], bytes(r["text"] or b"")) for r in numbered.where(F.col("block") == b).collect()]
        words = [(i, words_of([t])[0]) for i, t in sorted(items, key=str)]
        for chosen, parts in spaces_of([(i, w) for i, w in words if len(w)], rank):
            index = build_index(docs, chosen, parts, rank, text)
            if index is not None:
                yield spark.sparkContext.broadcast(index)


LIMITS = {"least_cosine": 0.7, "least_full": 0.18, "least_lcs": 0.6, "least_answer": 0.5}


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 96, block_items: int = 2000,
                 doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row for each row of ``docs`` and benchmark item that it holds: ``doc_id, item_id,
    cosine, lcs, answer, start`` (the shares of the item, and the word where the match begins).

    Null and empty texts hold nothing, null and empty items are held by nothing; null ids
    are returned as null; repeated rows and repeated items are each reported; an
    empty table on either side gives no rows; other columns are ignored.
    """
    limits = LIMITS | limits
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    out = docs.sparkSession.createDataFrame([], MATCH_SCHEMA)
    for shared in indexes(docs, benchmark, rank, block_items, text):
        def search(batches, shared=shared):
            for batch in batches:
                lines = []
                for doc, found in zip(batch.column(0).to_pylist(), shared.value.matches([t or b"" for t in batch.column(1).to_pylist()], **limits)):
                    lines += [(doc, shared.value.items[k][0], *v) for k, v in found.items()]
                cols = list(zip(*lines)) if lines else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "cosine", "lcs", "answer", "start"])

        out = out.union(rows.mapInArrow(search, MATCH_SCHEMA))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 96, block_items: int = 2000,
                      text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    limits = LIMITS | limits
    out = docs
    for shared in indexes(docs, benchmark, rank, block_items, text):
        def keep(batches, shared=shared):
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                yield batch.filter(pa.array([not m for m in shared.value.matches(texts, **limits)], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out
