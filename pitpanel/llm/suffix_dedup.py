"""Duplicate byte strings by a logarithmic family of suffix indexes.

The corpus' suffixes that start at an anchor (see :mod:`pitpanel.llm.windows`) are
dealt by the fingerprint of their prefix.  In each range of fingerprints, blocks of
documents arrive as batches: a batch is a sorted array of anchored suffixes, enters
as the lowest level, and levels of equal size merge, so that ``n`` batches leave at
most ``log2(n)`` levels.  Every batch is then merge-scanned against all levels for
prefixes found elsewhere.  The suffixes are ordered by the fingerprints of their
first ``width`` bytes rather than byte by byte: a match is a question of equality, and
the fingerprint order lets a range be dealt evenly whatever the text is.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from pitpanel.llm import blocks as B
from pitpanel.llm.hashing import BYTE_VALUES
from pitpanel.llm.windows import EMPTY, Matcher, Shape, SortedIndex

U = np.uint64
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


class LogFamily:
    """Levels of sorted suffix entries whose sizes grow geometrically."""

    def __init__(self):
        self.levels: list[SortedIndex] = []     # largest first

    def add(self, key, second, many, least) -> None:
        """A batch becomes the lowest level; a level no larger than twice the one above it merges."""
        order = np.lexsort((second, key))
        self.levels.append(SortedIndex(key[order], second[order], many[order], least[order]))
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels.append(self.levels.pop().merged(last))

    def look(self, keys):
        """Merge-scan of a batch against every level: rows of each key (2 at most),
        different seconds (2 at most), whether the second can be relied on, least doc."""
        rows, kinds, second, least = EMPTY.scan(keys)
        for level in self.levels:
            r, k, s, d = level.scan(keys)
            kinds = np.where(k == 0, kinds, np.where(kinds == 0, k, np.where((k == 1) & (kinds == 1) & (s == second), 1, 2)))
            second = np.where(k == 0, second, s)
            rows, least = np.minimum(rows + r, 2), np.minimum(least, d)
        return rows.astype(np.uint8), kinds, second != 0, least


def byte_symbols(row):
    _, bounds, raw = B.open_block(row)
    return BYTE_VALUES[raw], bounds


def byte_digest(row, removed):
    """Per document: bytes, removed bytes, maximal removed runs, digest of the rest."""
    ids, bounds, raw = B.open_block(row)
    kept = ~removed
    out = []
    for i, doc in enumerate(ids):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        gone = removed[lo:hi]
        turn = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)) if hi > lo else np.zeros(0, dtype=np.int64)
        rest = raw[lo:hi][kept[lo:hi]]
        out.append((doc, hi - lo, int(gone.sum()), len(turn) // 2, hashlib.sha256(rest.tobytes()).hexdigest(), turn.tolist()))
    return out


def repeated(count, least, own):
    return count >= 2


def duplicate_bytes(docs: DataFrame, width: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Removed is every UTF-8 byte inside a ``width``-byte string that starts anywhere
    else too, in this document or another, judged on the input.  ``spans`` holds the
    maximal removed runs as start, end, start, end, ... in bytes.

    Null text is empty; a null ``doc_id`` is returned as null; repeated rows are
    occurrences of their own; an empty table gives no rows; other columns are ignored.
    """
    gram = max(1, min(32, width // 8))
    step = max(1, width // 6)
    return Matcher(Shape(width, gram, step), byte_symbols, byte_digest, SCHEMA, LogFamily, repeated).run(docs, doc_id, text, "suffix")
