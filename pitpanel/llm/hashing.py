"""Vectorised byte, word and window hashing inside one task.

A window hash is a polynomial over Z/2^64 read off a prefix sum:
``sum(v[j] * B**j for j in window) * B**-start``; ``B`` is odd, so its powers
can be inverted.  Every value is finished with an avalanche mix.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASES = (U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (three xor-shifts, two odd multipliers)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])    # any byte beyond ASCII is a letter
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2^64."""
    p = np.full(max(n, 1), base, dtype=U)
    p[0] = 1
    return np.multiply.accumulate(p)[:n]


class Sequence:
    """Window hashes of one sequence of 64-bit symbol values."""

    def __init__(self, values: np.ndarray, base: int = 0):
        b = BASES[base]
        inverse = U(pow(int(b), -1, 1 << 64))
        self.sums = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * powers(b, len(values)), out=self.sums[1:])
        self.unscale = powers(inverse, len(values) + 1)

    def windows(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``[start, start + length)`` for every start."""
        return mix((self.sums[start + length] - self.sums[start]) * self.unscale[start])

    def all_windows(self, length: int) -> np.ndarray:
        """Hash of the window at every position that has one."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.unscale[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in linear time."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    rows = -(-len(x) // width)
    full = np.full(rows * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:len(x)] = x
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def word_hashes(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES,
                chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (``[^\\x20\\x09-\\x0D]+`` by default) of documents stored end to end.

    ``data`` holds the bytes, document ``i`` is ``data[bounds[i]:bounds[i+1]]``.
    Returns each word's hash, first byte, end byte, and the first word's index
    of every document (one more entry than documents).  Documents are hashed in
    groups of about ``chunk`` bytes so that the scratch arrays stay small.
    """
    hashes, starts, ends = [], [], []
    firsts = np.zeros(len(bounds), dtype=np.int64)
    i, n_words = 0, 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + chunk, side="right")) - 1)
        lo, hi = int(bounds[i]), int(bounds[j])
        part = data[lo:hi]
        inside = ~separators[part]
        before = np.zeros(len(part), dtype=bool)
        before[1:] = inside[:-1]
        cuts = bounds[i:j] - lo
        before[cuts[cuts < len(part)]] = False          # a document starts a new word
        first = inside & ~before
        after = np.zeros(len(part), dtype=bool)
        after[:-1] = inside[1:] & ~first[1:]
        s = np.flatnonzero(first)
        e = np.flatnonzero(inside & ~after) + 1
        seq = Sequence(BYTE_VALUES[part])
        hashes.append(mix((seq.sums[e] - seq.sums[s]) * seq.unscale[s] + (e - s).astype(U)))
        starts.append(s + lo)
        ends.append(e + lo)
        firsts[i:j] = n_words + np.searchsorted(s, cuts)
        n_words += len(s)
        i = j
    firsts[-1] = n_words
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, dtype=kind)
    return cat(hashes, U), cat(starts, np.int64), cat(ends, np.int64), firsts


class Lookup:
    """Values of 64-bit keys by open addressing; 0 for a key that isn't there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=U)
        self.values = np.zeros(1 << bits, dtype=values.dtype)
        keys, values = np.where(keys == 0, U(1), keys), values
        slot, self.probes = (keys & U(self.mask)).astype(np.int64), 0
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[slot] == 0)
            at, chosen = np.unique(slot[free], return_index=True)
            chosen = free[chosen]
            self.keys[at], self.values[at] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), dtype=bool)
            rest[chosen] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, and whether it is there."""
        keys = np.where(keys == 0, U(1), keys)
        slot = (keys & U(self.mask)).astype(np.int64)
        there = self.keys[slot]
        found = there == keys
        out = np.where(found, self.values[slot], 0).astype(self.values.dtype)
        left = np.flatnonzero(~found & (there != 0))
        for _ in range(self.probes):
            if not len(left):
                break
            at = (slot[left] + 1) & self.mask
            slot[left] = at
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[hit]]
            found[left[hit]] = True
            left = left[~hit & (there != 0)]
        return out, found
