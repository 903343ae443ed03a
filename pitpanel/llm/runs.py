"""Periodic runs of words, found on a grammar of the text.

A group of documents is Re-Paired: adjacent word ids that occur together at least
twice become a nonterminal, the most frequent pair first where pairs overlap, until
no pair repeats.  A run (a maximal stretch of period ``q``) has a lowest nonterminal
that holds it whole, and crosses the boundary between that nonterminal's two halves;
what no nonterminal holds crosses a boundary of the start sequence.  So runs are
looked for once at each boundary, however often the nonterminal occurs; they are
then carried to every place where the nonterminal is derived, and stretches of the
same period that overlap by a period are merged.

All of it happens inside one task on one group of whole documents (a grammar is not
shared between groups), so nothing is shuffled, and a lost task is computed anew from
the table.  Memory grows with a group (about ``GROUP_BYTES`` of text) or with the
longest document, whichever is more.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.blocks import arrow_schema
from pitpanel.llm.hashing import Sequence, word_hashes

GROUP_BYTES = 1 << 20
LEAST = 12            # words of the shortest run
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class Grammar:
    """Re-Pair of symbol sequences laid end to end (``firsts`` are their bounds).

    ``left``, ``right``: the halves of nonterminal ``n_terminals + i``; ``at``: where it
    occurs first; ``size``: words of every symbol; ``rounds``: id ranges of the rounds.
    ``symbols``, ``places``, ``ends``: the start sequence, where its symbols begin, and which
    are the last of their document.
    """

    def __init__(self, symbols: np.ndarray, firsts: np.ndarray):
        n = len(symbols)
        self.n_terminals = int(symbols.max()) + 1 if n else 0
        self.symbols, self.places = symbols.astype(np.int64), np.arange(n)
        self.ends = np.zeros(n, dtype=bool)
        lasts = firsts[1:][firsts[1:] > firsts[:-1]] - 1
        self.ends[lasts] = True
        self.size = np.ones(self.n_terminals, dtype=np.int64)
        left, right, at, self.rounds = [], [], [], []
        while len(chosen := self._choose()):
            i, rank, n_new = chosen[0], chosen[1], int(chosen[1].max()) + 1
            first = np.full(n_new, len(self.symbols), dtype=np.int64)
            np.minimum.at(first, rank, i)
            l, r = self.symbols[first], self.symbols[first + 1]
            left.append(l)
            right.append(r)
            at.append(self.places[first])
            self.rounds.append((len(self.size), len(self.size) + n_new))
            self.symbols[i] = len(self.size) + rank
            self.size = np.concatenate([self.size, self.size[l] + self.size[r]])
            self.ends[i] = self.ends[i + 1]
            stay = np.ones(len(self.symbols), dtype=bool)
            stay[i + 1] = False
            self.symbols, self.places, self.ends = self.symbols[stay], self.places[stay], self.ends[stay]
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
        self.left, self.right, self.at = cat(left), cat(right), cat(at)

    def _choose(self):
        """Positions of the pairs to replace in this round, and each pair's rank."""
        s = self.symbols
        if len(s) < 2:
            return ()
        keys = (s[:-1].astype(np.uint64) << np.uint64(32)) | s[1:].astype(np.uint64)
        bits = max(8, len(keys).bit_length() + 1)
        slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
        inside = ~self.ends[:-1]
        often = inside & (np.bincount(slot[inside], minlength=1 << bits)[slot] > 1)     # at least: slots may be shared
        where = np.flatnonzero(often)
        if not len(where):
            return ()
        _, kind, count = np.unique(keys[where], return_inverse=True, return_counts=True)
        if count.max() < 2:
            return ()
        order = np.empty(len(count), dtype=np.int64)
        order[np.argsort(count, kind="stable")] = np.arange(1, len(count) + 1)     # more frequent pairs go first
        weight = np.zeros(len(keys) + 2, dtype=np.int64)
        weight[where + 1] = np.where(count[kind] > 1, order[kind], 0)
        # equal neighbours are a stretch of one symbol: every other pair of it is taken
        new = np.flatnonzero(np.diff(weight, prepend=-1))
        stretch = np.cumsum(np.diff(weight, prepend=-1) != 0) - 1
        before, after = weight[np.maximum(new - 1, 0)], weight[np.append(new[1:], len(weight) - 1)]
        wins = (weight[new] > before) & (weight[new] > after)
        here = np.arange(len(weight))
        taken = wins[stretch] & ((here - new[stretch]) % 2 == 0) & (weight > 0)
        i = np.flatnonzero(taken) - 1
        _, rank, uses = np.unique(weight[i + 1], return_inverse=True, return_counts=True)
        keep = uses[rank] > 1                                                       # a rule that is used once is none
        if keep.sum() * 256 < len(s) and keep.sum() < 64:                           # what is left is found at the start sequence
            return ()
        i = i[keep]
        return i, np.unique(rank[keep], return_inverse=True)[1]

    def occurrences(self, wanted: np.ndarray):
        """Symbol and place of every derivation of the ``wanted`` symbols (a flag each)."""
        holds = wanted.copy()
        n = self.n_terminals
        for lo, hi in self.rounds:
            holds[lo:hi] |= holds[self.left[lo - n:hi - n]] | holds[self.right[lo - n:hi - n]]
        mine = holds[self.symbols]
        symbols, places = self.symbols[mine], self.places[mine]
        found = []
        for lo, hi in reversed(self.rounds):
            now = symbols >= lo
            x, p = symbols[now], places[now]
            found.append((x[wanted[x]], p[wanted[x]]))
            l, r = self.left[x - n], self.right[x - n]
            down, at = np.concatenate([l, r]), np.concatenate([p, p + self.size[l]])
            mine = holds[down]
            symbols, places = np.concatenate([symbols[~now], down[mine]]), np.concatenate([places[~now], at[mine]])
        return (np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (symbols[:0], places[:0])


def crossing_stretches(seq: Sequence, firsts: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Stretches of one period that cross boundary ``b`` inside ``[lo, hi)``: the index of the
    boundary, start, end and period of each.

    Words ``q`` apart agree over at least ``max(q, LEAST - q)`` positions of a run, so one of
    the windows of ``w`` words beside the boundary occurs again ``q`` words away, for any ``w`` up
    to half of that.  Periods are taken in classes of a factor four, each with the longest
    window that fits all of its periods.
    """
    n = len(seq.sums) - 1
    doc_of_end = np.repeat(firsts[1:], np.diff(firsts))
    longest = int(np.diff(firsts).max(initial=0))
    out = []
    least, most, width = 1, 15, 3
    while 2 * least <= longest:
        u = np.flatnonzero(np.arange(n) + width <= doc_of_end)
        if len(u):
            bits = np.uint64(max(1, int(n).bit_length()))
            mask = np.uint64((1 << int(bits)) - 1)
            keys = np.sort((seq.windows(u, width) & ~mask) | u.astype(np.uint64))
            place, same = (keys & mask).astype(np.int64), keys & ~mask
            rank = np.full(n + 1, -1, dtype=np.int64)
            rank[place] = np.arange(len(place))
            # windows that overlap by half lie in one stretch of a smaller period: of these, only the next
            # one counts (to the others the distance is a multiple of that period, not the smallest)
            tight = np.zeros(len(place) + 1, dtype=bool)
            tight[1:-1] = (same[1:] == same[:-1]) & (2 * np.diff(place) <= width)
            stretch = np.cumsum(~tight[:-1]) - 1
            edge = np.flatnonzero(~tight)                                      # first window of every stretch, and the end
            for offset, way in ((-width, 1), (-1, 1), (1 - width, -1), (0, -1)):
                a = b + offset
                k = np.flatnonzero((a >= lo) & (a + width <= hi))
                at = rank[a[k]]
                k, at = k[at >= 0], at[at >= 0]
                other = at + way
                while len(k):
                    ok = (other >= 0) & (other < len(place))
                    k, at, other = k[ok], at[ok], other[ok]
                    far = np.abs(place[other] - place[at])
                    ok = (same[other] == same[at]) & (far <= most)
                    k, at, other, far = k[ok], at[ok], other[ok], far[ok]
                    hit = (far >= least) & (place[other] >= lo[k]) & (place[other] + width <= hi[k])
                    if hit.any():
                        out.append((k[hit], np.minimum(place[at], place[other])[hit], far[hit], np.full(hit.sum(), width)))
                    beyond = edge[stretch[at] + 1] if way > 0 else edge[stretch[at]] - 1
                    other = np.where(stretch[other] == stretch[at], beyond, other + way)
        least, most, width = (16, 63, 8) if least == 1 else (least * 4, most * 4 + 3, width * 4)
    if not out:
        return [np.zeros(0, dtype=np.int64)] * 4
    k, u, q, w = (np.concatenate(c) for c in zip(*out))
    start = u - _agree(seq, u, u + q, u - lo[k], back=True)
    end = u + w + q + _agree(seq, u + w, u + w + q, hi[k] - (u + w + q), back=False)
    long = end - start >= np.maximum(2 * q, LEAST)
    return k[long], start[long], end[long], q[long]


def _agree(seq: Sequence, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from ``x`` and ``y`` on (or before them), ``most`` at the most."""
    good, bad = np.zeros(len(x), dtype=np.int64), most + 1
    while len(open_ := np.flatnonzero(bad - good > 1)):
        n = (good[open_] + bad[open_]) // 2
        i, j = (x[open_] - n, y[open_] - n) if back else (x[open_], y[open_])
        equal = seq.windows(i, n) == seq.windows(j, n)
        good[open_[equal]], bad[open_[~equal]] = n[equal], n[~equal]
    return good


def merge(start: np.ndarray, end: np.ndarray, q: np.ndarray):
    """Union of stretches of one period that overlap by a period at least."""
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    if not len(q):
        return start, end, q
    group = np.cumsum(np.diff(q, prepend=q[0]) != 0)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = np.ones(len(q), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - q[1:])
    first = np.flatnonzero(new)
    return start[first], np.maximum.reduceat(end, first), q[first]


def find_runs(values: np.ndarray, firsts: np.ndarray):
    """Start, end and period of every run of word values laid end to end, by start, then period."""
    grammar = Grammar(np.unique(values, return_inverse=True)[1], firsts)
    n = grammar.n_terminals
    doc_lo, doc_hi = np.repeat(firsts[:-1], np.diff(firsts)), np.repeat(firsts[1:], np.diff(firsts))
    whole = np.flatnonzero(grammar.size[n:] >= LEAST)                        # shorter nonterminals hold no run
    middle = grammar.at[whole] + grammar.size[grammar.left[whole]]
    between = grammar.places[1:][~grammar.ends[:-1]]
    between = between[doc_hi[between] - doc_lo[between] >= LEAST]
    b = np.concatenate([middle, between])
    lo = np.concatenate([grammar.at[whole], doc_lo[between]])
    hi = np.concatenate([grammar.at[whole] + grammar.size[n + whole], doc_hi[between]])
    seq = Sequence(values)
    k, start, end, q = crossing_stretches(seq, firsts, b, lo, hi)

    inner = k < len(whole)
    rule = whole[k[inner]] + n
    order = np.argsort(rule, kind="stable")
    rule, shift = rule[order], (start - lo[k])[inner][order]
    length, period = (end - start)[inner][order], q[inner][order]
    wanted = np.zeros(len(grammar.size), dtype=bool)
    wanted[rule] = True
    symbols, places = grammar.occurrences(wanted)
    first, last = np.searchsorted(rule, symbols, side="left"), np.searchsorted(rule, symbols, side="right")
    which = np.repeat(first - np.cumsum(last - first) + (last - first), last - first) + np.arange((last - first).sum())
    moved = np.repeat(places, last - first) + shift[which]
    start, end, q = merge(np.concatenate([moved, start[~inner]]), np.concatenate([moved + length[which], end[~inner]]),
                          np.concatenate([period[which], q[~inner]]))
    start, end, q = _exact(values, start, end, q)
    order = np.lexsort((q, end, start))                                      # of one stretch, the smallest period
    start, end, q = start[order], end[order], q[order]
    keep = np.ones(len(q), dtype=bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _exact(values: np.ndarray, start, end, q):
    """The stretches with their words compared one by one (windows were compared by hash)."""
    out = []
    for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()):
        differ = values[s:e - p] != values[s + p:e]
        if not differ.any():
            out.append((s, e, p))
            continue
        cuts = [-1, *np.flatnonzero(differ).tolist(), e - p - s]
        out += [(s + x + 1, s + y + p, p) for x, y in zip(cuts, cuts[1:]) if y - x - 1 >= max(p, LEAST - p)]
    return np.array(sorted(set(out)), dtype=np.int64).reshape(-1, 3).T


def repeated_tail(doc_id, n: int) -> np.ndarray | None:
    """Word numbers of a document whose tail is made periodic for the check of this operator:
    of those whose crc32 of the id is divisible by ten, words from ``a`` on repeat with period ``p``."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def group_runs(ids: list, texts: list[bytes], rewrite) -> list[tuple]:
    """Result rows of one group of documents."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    hashes, _, _, firsts = word_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds)
    moved = {}
    for d, doc_id in enumerate(ids):
        lo, hi = int(firsts[d]), int(firsts[d + 1])
        order = rewrite(doc_id, hi - lo) if rewrite else None
        if order is not None:
            moved[d] = order
    values = hashes.copy()
    for d, order in moved.items():
        values[firsts[d]:firsts[d + 1]] = hashes[firsts[d] + order]
    start, end, q = find_runs(values, firsts)
    owner = np.searchsorted(firsts, start, side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
    rows = []
    for d, (doc_id, text) in enumerate(zip(ids, texts)):
        words = text.split()
        if d in moved:
            words = [words[i] for i in moved[d].tolist()]
        mine = slice(cuts[d], cuts[d + 1])
        s, n, p = (start[mine] - firsts[d]), (end - start)[mine], q[mine]
        best = (None,) * 4
        if len(s):
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(gone, s + p, 1)
            np.add.at(gone, s + n, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
            i = np.lexsort((p, s, -n))[0]
            best = (int(s[i]), int(n[i]), int(p[i]), 1000 * int(n[i]) // int(p[i]))
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), p.tolist()))
        rows.append((doc_id, len(s), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
                     list(zip(s.tolist(), n.tolist(), p.tolist())), b" ".join(words).decode()))
    return rows


def _groups(batches, group_bytes: int):
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or b""
            if texts and size + len(text) > group_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def _task(batches, rewrite, group_bytes: int, full: bool):
    schema = arrow_schema(SCHEMA)
    if full:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        schema = pa.schema([*schema, ("runs", pa.list_(run)), ("collapsed", pa.string())])
    for ids, texts in _groups(batches, group_bytes):
        columns = list(zip(*group_runs(ids, texts, rewrite)))
        yield pa.RecordBatch.from_arrays([_column(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind):
        values = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in values]
    return pa.array(list(values), kind)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite=None,
                  group_bytes: int = GROUP_BYTES, full: bool = True) -> DataFrame:
    """The periodic runs of every document, one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of at least ``max(12, 2 * period)``
    words with that smallest period which no neighbouring word extends.  Columns: ``doc_id``, ``n_runs``,
    the longest run (``start``, ``length``, ``period``, ``exponent_milli``; ties: smallest start, then period;
    null without one), hashes of the run list and of the collapsed text, and with ``full``
    the runs themselves and the collapsed text (each run cut to its first period).
    ``rewrite(doc_id, n)`` may give word numbers to read a document's words by.

    A null or empty text has no words and no runs; a null id stays null; repeated rows give a row
    each; an empty table gives no rows; further columns are ignored.  A very long text is a group of
    its own and needs memory in proportion to its words.
    """
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    ddl = SCHEMA + (", runs array<struct<start:long,length:long,period:long>>, collapsed string" if full else "")
    return rows.mapInArrow(functools.partial(_task, rewrite=rewrite, group_bytes=group_bytes, full=full), ddl)
