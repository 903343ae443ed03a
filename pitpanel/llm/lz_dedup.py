"""Duplicate word spans by relative Lempel-Ziv factors.

Every block of documents is a reference block; its phrases (anchored word sequences,
see :mod:`pitpanel.llm.windows`) are indexed by fingerprint, and the phrases of all
documents are looked up in every reference block at once, because Spark deals blocks
and documents by the same fingerprint.  No factor is parsed word by word: a stretch that another
document holds shows as phrases with the same surroundings, and where such a stretch may begin or
end the windows of ``width`` words are compared one by one.  Every window that a document with a
smaller id holds becomes part of a duplicate span.

A null or empty text has no words.  A very long text is a block of its own and is held whole in
one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from pitpanel.llm import blocks as B
from pitpanel.llm.hashing import word_hashes
from pitpanel.llm.windows import EMPTY, Matcher, Shape, SortedIndex

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<long>"


class PhraseIndex:
    """Phrases of all reference blocks of one fingerprint range, sorted once."""

    def __init__(self):
        self.batches: list[tuple] = []
        self.index: SortedIndex | None = None

    def add(self, *batch) -> None:
        self.batches.append(batch)

    def look(self, keys):
        """Rows of each phrase (2 at most), different surroundings (2 at most), whether
        these can be relied on, and the least document that holds it."""
        if self.index is None:
            self.index = EMPTY.merged(SortedIndex(*(np.concatenate(c) for c in zip(*self.batches))))
            self.batches = []
        rows, kinds, second, least = self.index.scan(keys)
        return rows.astype(np.uint8), kinds, second != 0, least


def word_symbols(row):
    _, bounds, raw = B.open_block(row)
    values, _, _, firsts = word_hashes(raw, bounds)
    return values, firsts


def word_digest(row, removed):
    """Per document: words, removed words, digest of the kept words joined by spaces."""
    ids, bounds, raw = B.open_block(row)
    data, out, at = raw.tobytes(), [], 0
    for i, doc in enumerate(ids):
        words = data[bounds[i]:bounds[i + 1]].split()
        gone = removed[at:at + len(words)]
        at += len(words)
        if gone.any():
            turn = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
            words_kept = [w for w, g in zip(words, gone.tolist()) if not g]
        else:
            turn, words_kept = [], words
        out.append((doc, len(words), len(words) - len(words_kept), hashlib.sha256(b" ".join(words_kept)).hexdigest(), turn))
    return out


def in_smaller_document(count, least, own):
    return least < own


def duplicate_words(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, spans``.

    Words are runs without ASCII white space, unchanged.  Removed is every word inside
    a sequence of ``width`` words that also occurs in a document with a smaller
    ``doc_id``, judged on the input.  ``spans`` holds the maximal removed runs as start,
    end, ... in words.

    Null text has no words; a null ``doc_id`` is larger than all others; rows that share
    a ``doc_id`` are never smaller than each other; an empty table gives no rows; other
    columns are ignored.
    """
    gram = max(1, min(6, width // 4))
    step = max(1, width // 6)
    return Matcher(Shape(width, gram, step), word_symbols, word_digest, SCHEMA, PhraseIndex, in_smaller_document).run(docs, doc_id, text, "lz")
