"""A bigram trie in Elias-Fano coding: monotone pointers, quantised logarithms, levels in one memory map."""

from __future__ import annotations

import mmap

import numpy as np

#: For each byte the places of its ones, in order, and how many there are.
_ONES = np.zeros((256, 8), np.int64)
_COUNT = np.array([k.bit_count() for k in range(256)], np.int64)
for _k in range(256):
    _at = [b for b in range(8) if _k >> b & 1]
    _ONES[_k, : len(_at)] = _at


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Where the k-th one (zero if flip) of a bit vector is; before: how many lie before each 64-bit word."""
    w = np.searchsorted(before, k, "right") - 1
    left = k - before[w]
    bits = np.ascontiguousarray(words[w])
    octets = (~bits if flip else bits).view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_COUNT[octets], 1)
    byte = (upto <= left[:, None]).sum(1)
    rows = np.arange(len(k))
    left = left - np.where(byte > 0, upto[rows, np.maximum(byte - 1, 0)], 0)
    return w * 64 + byte * 8 + _ONES[octets[rows, byte], left]


class EliasFano:
    """A non-decreasing sequence of n integers below a universe, in about 2 + log2(universe / n) bits each.

    The low bits of each are packed side by side. The high bits are a bit vector: for each value of the high part its
    members as ones, then a zero. Counts of zeros before each 64-bit word make select of a zero one search.
    """

    FIELDS = ("low", "high", "zeros")

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray) -> None:
        self.n, self.bits, self.low, self.high, self.zeros = n, bits, low, high, zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        v = values.astype(np.uint64)
        n = len(v)
        bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        words = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = v & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            w, s = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(words, w, part << s)
            over = np.flatnonzero(s + np.uint64(bits) > 64)
            np.bitwise_or.at(words, w[over] + 1, part[over] >> (np.uint64(64) - s[over]))
        top = (v >> np.uint64(bits)).astype(np.int64)
        size = n + (universe >> bits) + 2
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[top + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.add.reduceat(flags, np.arange(0, len(flags), 64), dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(64 - ones)])[:-1].astype(np.int64)
        return cls(n, bits, words, high, zeros)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        return _select(self.high, self.zeros, k, True)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        w, s = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        more = np.where(s > 0, self.low[w + 1] << ((np.uint64(64) - s) & np.uint64(63)), np.uint64(0))
        return ((self.low[w] >> s) | more) & np.uint64((1 << self.bits) - 1)

    def bucket(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index range of members whose high part is top."""
        first = np.where(top > 0, self._select0(np.maximum(top - 1, 0)) - (top - 1), 0)
        return first, self._select0(top) - top

    def get(self, i: np.ndarray) -> np.ndarray:
        """The members at indexes i."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        top = _select(self.high, ones, i, False) - i
        return (top.astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def _last_top(self) -> int:
        return int(self.zeros[-1] + (64 - int(self.high[-1]).bit_count())) - 1

    def successor(self, value: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """The index of the first member that is value or more (n if none), searched in [first, last) if given."""
        v = value.astype(np.uint64)
        a, b = self.bucket((v >> np.uint64(self.bits)).astype(np.int64))
        if first is not None:
            a, b = np.clip(a, first, last), np.clip(b, first, last)
        low = v & np.uint64((1 << self.bits) - 1)
        while (a < b).any():
            mid = (a + b) // 2
            less = self._low(np.minimum(mid, max(self.n - 1, 0))) < low
            a, b = np.where((a < b) & less, mid + 1, a), np.where((a < b) & ~less, mid, b)
        return a


class Quantiser:
    """Values in a range by 16-bit steps."""

    def __init__(self, low: float, high: float) -> None:
        self.low, self.step = low, max(high - low, 1e-9) / 65535

    def code(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.rint((x - self.low) / self.step), 0, 65535).astype(np.uint16)

    def value(self, q: np.ndarray) -> np.ndarray:
        return self.low + np.asarray(q, float) * self.step


class Trie:
    """For each context its successors, found by a search among that context's alone, each with a quantised value.

    pointers: where each context's successors begin. successors: their word ids, relative to the context: each context
    adds the last value of the one before, so that the level is monotone. Contexts are 0 to contexts - 1.
    """

    def __init__(self, contexts: int, pointers: EliasFano, successors: EliasFano, shift: np.ndarray, codes: np.ndarray, scale: Quantiser) -> None:
        self.contexts, self.pointers, self.successors, self.shift, self.codes, self.scale = contexts, pointers, successors, shift, codes, scale

    @classmethod
    def build(cls, contexts: int, context: np.ndarray, word: np.ndarray, value: np.ndarray, low: float, high: float) -> Trie:
        """context and word: the pairs in order; value: theirs, from low to high."""
        begin = np.searchsorted(context, np.arange(contexts + 1))
        last = np.zeros(contexts, np.int64)
        full = np.flatnonzero(begin[1:] > begin[:-1])
        last[full] = word[begin[1:][full] - 1] + 1
        shift = np.cumsum(last) - last
        scale = Quantiser(low, high)
        successors = EliasFano.build(word + shift[context] if len(context) else word, int(last.sum()) + 1)
        return cls(contexts, EliasFano.build(begin, len(word) + 1), successors, shift, scale.code(value), scale)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each pair in the level, or -1."""
        if not self.successors.n or not len(context):
            return np.full(len(context), -1, np.int64)
        each, which = np.unique(context, return_inverse=True)
        first, after = self.pointers.get(each).astype(np.int64)[which], self.pointers.get(each + 1).astype(np.int64)[which]
        own = np.flatnonzero(after > first)
        out = np.full(len(context), -1, np.int64)
        ctx = context[own]
        span = np.append(self.shift[1:], self.shift[-1:] if len(self.shift) else [0])[ctx]
        value = word[own] + self.shift[ctx]
        # Beyond the context's last successor there is nothing; for the last context any value may be.
        inside = (value < span) | (ctx == self.contexts - 1) | (span <= self.shift[ctx])
        own, value = own[inside], value[inside]
        value = np.minimum(value, self._top)
        i = self.successors.successor(value, first[own], after[own])
        ok = i < after[own]
        i, own, value = i[ok], own[ok], value[ok]
        hit = self.successors.get(i).astype(np.int64) == word[own] + self.shift[context[own]]
        out[own[hit]] = i[hit]
        return out

    @property
    def _top(self) -> int:
        return ((self.successors._last_top() + 1) << self.successors.bits) - 1

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """For each pair 0 if it is not in the trie, else 1 plus its value's code."""
        at = self.find(context, word)
        return np.where(at >= 0, self.codes[np.maximum(at, 0)].astype(np.int64) + 1, 0) if len(self.codes) else np.zeros(len(context), np.int64)

    def mapped(self) -> Trie:
        """The same trie with all its levels side by side in one anonymous memory map."""
        parts = [self.shift, self.codes, *(getattr(level, k) for level in (self.pointers, self.successors) for k in EliasFano.FIELDS)]
        sizes = [-(-x.nbytes // 8) * 8 for x in parts]
        room = mmap.mmap(-1, max(8, sum(sizes)))
        views, at = [], 0
        for x, size in zip(parts, sizes, strict=True):
            view = np.frombuffer(room, x.dtype, len(x), at)
            view[:] = x
            view.flags.writeable = False
            views.append(view)
            at += size
        k = len(EliasFano.FIELDS)
        levels = [EliasFano(level.n, level.bits, *views[2 + k * i : 2 + k * (i + 1)]) for i, level in enumerate((self.pointers, self.successors))]
        return Trie(self.contexts, *levels, views[0], views[1], self.scale)
