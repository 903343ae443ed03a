"""Anchored windows: which fixed-length windows of a corpus occur elsewhere.

Shared by the byte (suffix index) and word (Lempel-Ziv) operators.  Every
window of ``width`` symbols is anchored at its minimal ``gram`` (a minimiser), so
equal windows have equal anchors at equal offsets.  Windows of one document with
the same anchor and an offset in the same ``step``-wide band form a *cell*.  A
cell is described by two substrings that depend on nothing but the text around
the anchor: the part all of its windows share (``inner``) and the part they cover
together (``outer``).  Then

* an ``inner`` that occurs once: no window of the cell occurs elsewhere;
* an ``inner`` that always has the same ``outer``: all windows of the cell occur
  as often as the ``inner``;
* otherwise a match ends inside some cell of that ``inner``: only these windows are
  compared one by one, in a second exchange.

So a corpus costs about two entries for ``width`` symbols and its long matches
cost no more than its unique text.  Nothing is sampled: the answer is exact up to
collisions of 64-bit fingerprints (a removal needs two of them to collide, over
different bases).
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import blocks as B
from pitpanel.llm.hashing import Sequence, mix, sliding_min
from pitpanel.session import materialize

U = np.uint64
NO_DOC = np.iinfo(np.int64).max
UNIQUE, SETTLED, OPEN = 0, 1, 2
CHUNK = 1 << 17         # window starts hashed at once


@dataclass(frozen=True)
class Shape:
    """Window width, anchor gram and band step, in symbols."""

    width: int
    gram: int
    step: int


@dataclass
class Cells:
    """Cells of a block, one row each; windows ``first .. last`` belong to it."""

    inner: np.ndarray
    outer: np.ndarray
    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray


def find_cells(values: np.ndarray, bounds: np.ndarray, shape: Shape, chunk: int = CHUNK) -> Cells:
    """Cells of documents whose symbol values are stored end to end.

    Window starts are worked off in chunks, so scratch arrays don't grow with a document;
    a cell that a chunk's end cuts is put together again.
    """
    n = len(values) - shape.width + 1
    pieces: list[tuple] = []
    for at in range(0, n, chunk):
        piece = cells_between(values, bounds, shape, at, min(at + chunk, n))
        if pieces and len(piece[2]) and len(pieces[-1][2]):
            before = pieces[-1]
            # neighbours with the same anchor and band in the same document are one cell
            if before[3][-1] + 1 == piece[2][0] == at and all(before[i][-1] == piece[i][0] for i in (4, 5, 6)):
                before[3][-1] = piece[3][0]
                piece = tuple(x[1:] for x in piece)
                if not len(piece[2]):
                    continue
        pieces.append(piece)
    if not pieces:
        none = np.zeros(0, dtype=np.int64)
        return Cells(none.astype(U), none.astype(U), none, none, none)
    return Cells(*(np.concatenate(x) for x in list(zip(*pieces))[:5]))


def cells_between(values: np.ndarray, bounds: np.ndarray, shape: Shape, begin: int, end: int) -> tuple:
    """Inner, outer, first, last, doc, anchor and band of the cells whose windows start
    in ``begin .. end - 1``."""
    w, step = shape.width, shape.step
    base = max(begin - step + 1, 0)             # as far as an outer part reaches
    part = values[base:end + w + step - 1]
    one, two = Sequence(part, 0), Sequence(part, 1)
    # the minimal gram of each window; ties go to the leftmost
    lo, size = begin - base, end - begin + w - shape.gram
    grams = one.all_windows(shape.gram)[lo:lo + size]
    grams = (grams & U(0xFFFFFFFF00000000)) | np.arange(size, dtype=U)
    anchor = (sliding_min(grams, w - shape.gram + 1) & U(0xFFFFFFFF)).astype(np.int64) + begin
    del grams
    starts = np.arange(begin, end)
    band = (anchor - starts) // step
    some = np.arange(np.searchsorted(bounds, begin, side="right") - 1, np.searchsorted(bounds, end - 1, side="right"))
    sizes = np.maximum(np.minimum(bounds[some + 1], end) - np.maximum(bounds[some], begin), 0)
    doc = np.repeat(some, sizes)
    # a window must end in the document it starts in
    valid = starts <= np.repeat(bounds[some + 1] - w, sizes)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (band[1:] != band[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    a, j, doc = anchor[first], band[first], doc[first]
    lo, size = a - step * j, w - step + 1
    inner = mix(one.windows(lo - base, size) + j.astype(U))
    lo, size = lo - step + 1, w + step - 1
    whole = (lo >= bounds[doc]) & (lo + size <= bounds[doc + 1])
    outer = np.zeros(len(first), dtype=U)
    outer[whole] = two.windows(lo[whole] - base, size) | U(1)     # 0: not provable
    return inner, outer, first + begin, last + begin, doc, a, j


def window_keys(values: np.ndarray, at: np.ndarray, width: int, chunk: int = CHUNK) -> np.ndarray:
    """Hash of the window at each of the ascending positions, in chunks."""
    keys = np.empty(len(at), dtype=U)
    for lo in range(0, len(values), chunk):
        i, j = np.searchsorted(at, [lo, lo + chunk])
        if i < j:
            keys[i:j] = Sequence(values[lo:lo + chunk + width - 1], 1).windows(at[i:j] - lo, width)
    return keys


def ordinals(ids: list) -> np.ndarray:
    """Document ids for comparing; a null id comes after all others."""
    return np.array([NO_DOC if i is None else i for i in ids], dtype=np.int64)


def distinct(keys: np.ndarray, second: np.ndarray, docs: np.ndarray):
    """Distinct (key, second) with the number of rows (2 at most) and the least doc,
    and the index of every row's entry."""
    order = np.lexsort((docs, second, keys))
    k, s, d = keys[order], second[order], docs[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(new)
    entry = np.empty(len(k), dtype=np.int64)
    entry[order] = np.cumsum(new) - 1
    many = np.minimum(np.diff(np.append(at, len(k))), 2).astype(np.uint8)
    return k[at], s[at], many, d[at], entry


def within(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside the ranges ``first .. last``, which don't overlap."""
    step = np.zeros(n + 1, dtype=np.int8)
    step[first] += 1
    step[last + 1] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def covered(starts_dup: np.ndarray, n: int, width: int) -> np.ndarray:
    """Symbols inside a window that starts at a marked position."""
    step = np.zeros(n + 1, dtype=np.int32)
    at = np.flatnonzero(starts_dup)
    step[at] += 1
    step[at + width] -= 1           # starts are distinct, so plain indexing adds up
    return np.cumsum(step[:-1], dtype=np.int32) > 0


class Matcher:
    """The two exchanges for one kind of symbols.

    ``symbols(row)`` gives a block row's symbol values and document bounds;
    ``digest(row, removed)`` the result rows, from the mask of removed symbols;
    ``index()`` makes the reducer's index, with ``add(batch)`` and ``look(batch)``
    (see :class:`SortedIndex`); ``is_dup(count, least, own)`` decides on windows.
    """

    def __init__(self, shape: Shape, symbols, digest, digest_schema: str, index, is_dup):
        self.shape, self.symbols, self.digest, self.digest_schema = shape, symbols, digest, digest_schema
        self.index, self.is_dup = index, is_dup

    # first exchange: cells

    def _cell_entries(self, row):
        values, bounds = self.symbols(row)
        cells = find_cells(values, bounds, self.shape)
        return cells, distinct(cells.inner, cells.outer, ordinals(row["ids"])[cells.doc])

    def cell_rows(self, row, parts):
        _, (inner, outer, many, least, _) = self._cell_entries(row)
        return B.deal(row["block"], inner, parts, outer, many, least)[0]

    def answer_cells(self, rows):
        """Codes and least docs for each batch of cells, from the index of all."""
        index = self.index()
        batches = [B.unpack(r["payload"], r["n"], U, U, np.uint8, np.int64) for r in rows]
        for batch in batches:
            index.add(*batch)
        out = []
        for r, (inner, outer, *_) in zip(rows, batches):
            count, outers, provable, least = index.look(inner)
            code = np.where(count < 2, UNIQUE, np.where((outers == 1) & provable, SETTLED, OPEN)).astype(np.uint8)
            out.append((r["part"], r["block"], r["n"], B.pack(code, count, least)))
        return out

    # second exchange: the windows of open cells

    def settle(self, row, answers, parts):
        """Finished documents, and for the others what is known and what is to compare."""
        values, bounds = self.symbols(row)
        cells, (inner, _, _, _, entry) = self._cell_entries(row)
        code, count, least = (np.zeros(len(inner), dtype=k) for k in (np.uint8, np.uint8, np.int64))
        order = np.argsort(B.part_of(inner, parts), kind="stable")
        if answers:
            got = [B.unpack(a["payload"], a["n"], np.uint8, np.uint8, np.int64) for a in answers]
            code[order], count[order], least[order] = (np.concatenate(x) for x in zip(*got))
        own = ordinals(row["ids"])
        marks = np.zeros(len(values) + 1, dtype=np.uint8)       # of window starts: 1 known to be duplicate, 2 open
        dup = (code[entry] == SETTLED) & self.is_dup(count[entry], least[entry], own[cells.doc])
        marks[:-1][within(cells.first[dup], cells.last[dup], len(values))] = 1
        wait = code[entry] == OPEN
        marks[:-1][within(cells.first[wait], cells.last[wait], len(values))] = 2
        waiting = np.zeros(len(bounds) - 1, dtype=bool)
        waiting[cells.doc[wait]] = True
        raw_ids, raw_bounds, raw = B.open_block(row)
        done, todo, lines = {}, {}, []
        for flag, into in ((False, done), (True, todo)):
            which = np.flatnonzero(waiting == flag)
            if len(which):
                texts = [raw[raw_bounds[i]:raw_bounds[i + 1]].tobytes() for i in which]
                joined = b"".join(texts)
                into |= {"block": row["block"], "kind": row["kind"], "ids": [raw_ids[i] for i in which], "sizes": [len(t) for t in texts],
                         "n_bytes": len(joined), "payload": B.pa.compress(joined, codec="zstd", asbytes=True),
                         "marks": np.concatenate([marks[bounds[i]:bounds[i + 1]] for i in which])}
        if done:
            lines += [("done", None, None, None, None, None, None, None, None, *x) for x in self.digest(done, covered(done["marks"] == 1, len(done["marks"]), self.shape.width))]
        if todo:
            blank = (None,) * self.digest_width
            packed = B.pa.compress(todo["marks"].tobytes(), codec="zstd", asbytes=True)
            lines.append(("todo", None, todo["block"], len(todo["marks"]), todo["payload"], todo["ids"], todo["sizes"], todo["n_bytes"], packed, *blank))
            for part, block, n, payload in self._window_entries(todo, parts)[0]:
                lines.append(("windows", part, block, n, payload, None, None, None, None, *blank))
        return lines

    @property
    def digest_width(self):
        return len(self.digest_schema.split(", "))

    def _window_entries(self, todo, parts):
        values, bounds = self.symbols(todo)
        at = np.flatnonzero(todo["marks"] == 2)
        doc = np.searchsorted(bounds, at, side="right") - 1
        keys = window_keys(values, at, self.shape.width)
        own = ordinals(todo["ids"])[doc]
        key, zero, many, least, entry = distinct(keys, np.zeros(len(keys), dtype=U), own)
        rows, order = B.deal(todo["block"], key, parts, many, least)
        return rows, (at, own, order, entry)

    def answer_windows(self, rows):
        index = self.index()
        batches = [B.unpack(r["payload"], r["n"], U, np.uint8, np.int64) for r in rows]
        for key, many, least in batches:
            index.add(key, np.zeros(len(key), dtype=U), many, least)
        out = []
        for r, (key, *_) in zip(rows, batches):
            count, _, _, least = index.look(key)
            out.append((r["part"], r["block"], r["n"], B.pack(count, least)))
        return out

    def finish(self, row, answers, parts):
        marks = np.frombuffer(B.pa.decompress(row["marks"], decompressed_size=row["n"], codec="zstd", asbytes=True), dtype=np.uint8)
        todo = row | {"marks": marks, "kind": 0}
        _, (at, own, order, entry) = self._window_entries(todo, parts)
        count, least = np.zeros(len(order), dtype=np.uint8), np.zeros(len(order), dtype=np.int64)
        if answers:
            got = [B.unpack(a["payload"], a["n"], np.uint8, np.int64) for a in answers]
            count[order], least[order] = (np.concatenate(x) for x in zip(*got))
        dup = marks == 1
        dup[at] = self.is_dup(count[entry], least[entry], own)
        return self.digest(todo, covered(dup, len(marks), self.shape.width))

    # the job

    def run(self, docs: DataFrame, doc_id: str, text: str, name: str) -> DataFrame:
        parts = B.n_parts(B.text_bytes(docs, text))
        blocks = B.make_blocks(docs, doc_id=doc_id, text=text, name=f"{name}-blocks")
        cells = B.map_blocks(blocks, functools.partial(self.cell_rows, parts=parts), B.EXCHANGE_SCHEMA)
        codes = B.reduce_parts(cells, self.answer_cells)
        mixed = ("what string, part int, block long, n long, payload binary, ids array<long>, sizes array<long>, text_bytes long, marks binary, "
                 + self.digest_schema)
        known = materialize(B.by_block(blocks, codes, functools.partial(self.settle, parts=parts), mixed), f"{name}-settled")
        windows = known.where(F.col("what") == "windows").select("part", "block", "n", "payload")
        answers = B.reduce_parts(windows, self.answer_windows)
        todo = known.where(F.col("what") == "todo").select("block", "n", "payload", "ids", "sizes", F.col("text_bytes").alias("n_bytes"), "marks")
        late = B.by_block(todo, answers, functools.partial(self.finish, parts=parts), self.digest_schema)
        columns = [c.split()[0] for c in self.digest_schema.split(", ")]
        return known.where(F.col("what") == "done").select(*columns).unionByName(late)


class SortedIndex:
    """Sorted entries (key, second) with counts and least docs, looked up by key."""

    def __init__(self, key, second, many, least):
        self.key, self.second, self.many, self.least = key, second, many, least

    def __len__(self):
        return len(self.key)

    def merged(self, other: SortedIndex) -> SortedIndex:
        """Merge of two sorted indexes; equal entries become one."""
        key, second = np.concatenate([self.key, other.key]), np.concatenate([self.second, other.second])
        many = np.concatenate([self.many, other.many]).astype(np.int64)
        least = np.concatenate([self.least, other.least])
        order = np.lexsort((second, key))
        key, second = key[order], second[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
        at = np.flatnonzero(new)
        if not len(at):
            return self
        return SortedIndex(key[at], second[at], np.minimum(np.add.reduceat(many[order], at), 2).astype(np.uint8),
                           np.minimum.reduceat(least[order], at))

    def scan(self, keys: np.ndarray):
        """For each key: its rows (2 at most), different seconds (2 at most), one of
        them (0: not provable or several), and its least doc."""
        lo, hi = np.searchsorted(self.key, keys), np.searchsorted(self.key, keys, side="right")
        n = hi - lo
        rows = np.zeros(len(keys), dtype=np.int64)
        least = np.full(len(keys), NO_DOC)
        second = np.zeros(len(keys), dtype=U)
        some = np.flatnonzero(n > 0)
        if len(some):
            ends = np.empty(2 * len(some), dtype=np.int64)
            ends[0::2], ends[1::2] = lo[some], hi[some]
            padded_many = np.append(self.many.astype(np.int64), 0)
            padded_least = np.append(self.least, NO_DOC)
            rows[some] = np.add.reduceat(padded_many, ends)[0::2]
            least[some] = np.minimum.reduceat(padded_least, ends)[0::2]
            second[some] = self.second[lo[some]]
        return np.minimum(rows, 2), np.minimum(n, 2), second, least


EMPTY = SortedIndex(np.zeros(0, dtype=U), np.zeros(0, dtype=U), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64))
