"""Elias-Fano sequences and the two-level n-gram trie built on them.

All reads work on arrays of positions or values at once, straight on the bytes
of a (memory-mapped) file.
"""

from __future__ import annotations

import numpy as np

#: Values looked up at once.
CHUNK = 100_000
_POP = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
#: Position of the r-th one of a byte.
_SELECT = np.zeros((256, 8), dtype=np.uint8)
for _b in range(256):
    for _r, _p in enumerate([i for i in range(8) if _b >> i & 1]):
        _SELECT[_b, _r] = _p


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with a
    directory of the ones before every 64th bit."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, ones: np.ndarray):
        self.n, self.l, self.lows, self.highs, self.ones = n, low_bits, lows, highs, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @staticmethod
    def parts(values: np.ndarray, universe: int) -> list[np.ndarray]:
        """The arrays to store for sorted ``values`` below ``universe``."""
        v = values.astype(np.int64)
        n = len(v)
        l = max(0, int(universe // max(n, 1)).bit_length() - 1)
        bits = np.empty((n, l), dtype=np.uint8)
        for j in range(l):
            bits[:, j] = (v >> j) & 1
        lows = np.concatenate([np.packbits(bits.ravel(), bitorder="little"), np.zeros(8, np.uint8)])
        size = -(-(n + (universe >> l) + 2) // 64) * 64
        unary = np.zeros(size, dtype=np.uint8)
        unary[(v >> l) + np.arange(n)] = 1
        ones = np.concatenate([[0], np.cumsum(unary.reshape(-1, 64).sum(axis=1))])[:-1]
        return [np.array([n, l], "<i8"), lows, np.packbits(unary, bitorder="little"), ones.astype("<u4")]

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> EliasFano:
        (n, l), lows, highs, ones = parts
        return cls(int(n), int(l), lows, highs, ones.astype(np.int64))

    def low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), dtype=np.int64)
        at = i * self.l
        word = self.lows[(at >> 3)[:, None] + np.arange(8)].view("<u8")[:, 0] if len(i) else np.zeros(0, np.uint64)
        return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)).astype(np.int64)

    def _inside(self, word: np.ndarray, rank: np.ndarray, flip: int) -> np.ndarray:
        """Bit position of the ``rank``-th one (zero with ``flip``) of 64-bit words."""
        b = self.highs[word[:, None] * 8 + np.arange(8)] ^ flip
        total = np.cumsum(_POP[b], axis=1, dtype=np.int64)
        byte = (total <= rank[:, None]).sum(axis=1)
        row = np.arange(len(word))
        before = total[row, byte] - _POP[b[row, byte]]
        return word * 64 + byte * 8 + _SELECT[b[row, byte], rank - before]

    def select1(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, side="right") - 1
        return self._inside(word, i - self.ones[word], 0)

    def select0(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, i, side="right") - 1
        return self._inside(word, i - self.zeros[word], 255)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self.select1(i) - i) << self.l) | self.low(i)

    def locate(self, values: np.ndarray, lo=None, hi=None) -> np.ndarray:
        """Position of each value within ``[lo, hi)``, or -1: the run of equal
        high bits is found in the unary part, then its low bits are bisected."""
        if len(values) > CHUNK:  # bounds the working arrays
            parts = [slice(at, at + CHUNK) for at in range(0, len(values), CHUNK)]
            return np.concatenate([self.locate(values[p], None if lo is None else lo[p], None if hi is None else hi[p])
                                   for p in parts])
        if not self.n or not len(values):
            return np.full(len(values), -1, dtype=np.int64)
        v = values.astype(np.int64)
        high = v >> self.l
        known = high < 64 * len(self.ones) - self.n  # zeros there are
        high = np.where(known, high, 0)
        a = np.where(high > 0, self.select0(np.maximum(high - 1, 0)) - high + 1, 0)
        b = self.select0(high) - high
        if lo is not None:
            a, b = np.maximum(a, lo), np.minimum(b, hi)
        want, end = v & ((1 << self.l) - 1), b.copy()
        open_ = np.flatnonzero(a < b)
        while len(open_):
            mid = (a[open_] + b[open_]) >> 1
            less = self.low(mid) < want[open_]
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]
            open_ = open_[a[open_] < b[open_]]
        out = np.full(len(v), -1, dtype=np.int64)
        some = np.flatnonzero(known & (a < end))
        hit = some[self.low(a[some]) == want[some]]
        out[hit] = a[hit]
        return out


def write_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after another, each 8-byte aligned behind its type and length."""
    out = [len(arrays).to_bytes(8, "little")]
    for a in arrays:
        data = np.ascontiguousarray(a).tobytes()
        out.append(np.dtype(a.dtype).str.encode().ljust(8, b" ") + len(a).to_bytes(8, "little"))
        out.append(data + bytes(-len(data) % 8))
    return b"".join(out)


def read_arrays(data) -> list[np.ndarray]:
    """Views of the arrays in a buffer; nothing is copied."""
    view = memoryview(data)
    count, at, out = int.from_bytes(view[:8], "little"), 8, []
    for _ in range(count):
        kind = np.dtype(bytes(view[at:at + 8]).decode().strip())
        n = int.from_bytes(view[at + 8:at + 16], "little")
        out.append(np.frombuffer(view, kind, n, at + 16))
        at += 16 + -(-n * kind.itemsize // 8) * 8
    return out


def quantise(values: np.ndarray, bins: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """Codes (1 up) and the mean of each bin: bins of equal width between the
    extremes, so no value is off by more than the range over ``bins``."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    low = values.min()
    width = max(values.max() - low, 1e-12) / bins
    code = np.minimum(((values - low) / width).astype(np.int64), bins - 1)
    count = np.bincount(code, minlength=bins)
    means = np.bincount(code, weights=values, minlength=bins) / np.maximum(count, 1)
    return (code + 1).astype(np.uint8), np.concatenate([[np.nan], means])


class NgramTrie:
    """Words, and under each word its successors with their probability.

    Level 0 is the sorted word numbers and, as monotone pointers, where each
    word's successors start in level 1. Level 1 holds successors as positions
    in level 0, made monotone by adding what the words before have used, so a
    successor is searched relative to its context. Probabilities are codes.
    """

    def __init__(self, data):
        a = read_arrays(data)
        self.words, self.starts, self.successors = (EliasFano.of(a[4 * i: 4 * i + 4]) for i in range(3))
        self.codes, self.book = a[12], a[13]

    @staticmethod
    def build(words: np.ndarray, context: np.ndarray, successor: np.ndarray, log_p: np.ndarray) -> bytes:
        """From sorted distinct word numbers and the bigrams sorted by context
        and successor (positions in ``words``)."""
        n = len(words)
        starts = np.searchsorted(context, np.arange(n + 1))
        # each context's successors lie above the largest value of the context before
        last = np.zeros(n + 1, dtype=np.int64)
        used = starts[1:] > starts[:-1]
        last[1:][used] = successor[starts[1:][used] - 1] + 1
        base = np.cumsum(last)[:-1]
        values = base[context] + successor
        codes, book = quantise(log_p)
        return write_arrays([*EliasFano.parts(words, int(words[-1]) + 1 if n else 1), *EliasFano.parts(starts, len(context) + 1),
                             *EliasFano.parts(values, int(values[-1]) + 1 if len(values) else 1), codes, book])

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end position of the successors of words, and their base."""
        lo, hi = self.starts.access(context), self.starts.access(context + 1)
        base = np.zeros(len(context), dtype=np.int64)
        some = np.flatnonzero(lo > 0)
        base[some] = self.successors.access(lo[some] - 1) + 1
        return lo, hi, base

    def codes_of(self, contexts: np.ndarray, which: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of bigrams ``(contexts[which], successors)`` of word numbers; 0 if not there."""
        out = np.zeros(len(which), dtype=np.uint8)
        if not self.successors.n:
            return out
        c = self.words.locate(contexts)
        lo, hi, base = self.ranges(np.maximum(c, 0))
        kinds, inverse = np.unique(successors, return_inverse=True)
        s = self.words.locate(kinds)[inverse]
        some = np.flatnonzero((c[which] >= 0) & (s >= 0))
        w = which[some]
        at = self.successors.locate(base[w] + s[some], lo[w], hi[w])
        out[some[at >= 0]] = self.codes[at[at >= 0]]
        return out
