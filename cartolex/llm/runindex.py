"""Removal of repeated 100-byte strings by run-length indexes (run-compressed Burrows-Wheeler transforms).

1. Each text is swept for its anchors (see anchors.py). An anchor's context is the bytes of all windows that have it.
   Equal contexts (equal in 126 bits of two independent hashes, of the anchor and of the whole) are one: all but the
   earliest are covered whole, and their texts need not travel.
2. Contexts that share an anchor but differ may still share windows. Each side of a context whose key another context of
   the anchor has is a text, dealt to shards by that key; others share no window. A shard builds run-length indexes of
   earlier texts and streams the later ones' matching statistics through them; a window whose match is as long as a
   window is located by the sampled run ends, compared byte by byte, marked. A key with too many texts for one shard has
   its windows for texts, which are equal or share nothing.
3. What is covered meets the texts again, and is cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .anchors import WINDOW, anchors, side_key, side_starts

#: Texts of one key in a shard; those of a larger group are compared window by window.
GROUP = 2048
#: Contexts of one anchor hash that a task holds to compare their keys; those of more are all compared window by window.
HELD = 1 << 18
#: Bytes of contexts that a shard holds, about.
SHARD_BYTES = 1 << 19
#: Text that is swept at a time; longer texts are swept in pieces that overlap by a window.
SWEEP = 2 << 20


class RunLengthIndex:
    """The Burrows-Wheeler transform of some texts, by its runs, each text in a cell of its own choice.

    Texts of different cells match nothing of each other's: the symbols are pairs of cell and byte. What is kept of each
    run: its first and last rank, the text positions of both (the samples from which a match is located), the rank that
    its first symbol goes to (so that an LF step is one search), and, against the run of the same symbol before it, the
    threshold below which a rank is nearer to that one's end than to this one's start.
    """

    def __init__(self, texts: list[bytes], cells: np.ndarray) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1  # each text's end mark, which sorts before all bytes
        n = len(ends) and int(ends[-1]) + 1
        self.body = np.frombuffer(b"\0".join(texts) + b"\0" * 17, np.uint8)
        sign = self.body[:n].astype(np.int64) + 1
        sign[ends] = 0
        cell = np.repeat(np.asarray(cells, np.int64), sizes + 1)
        #: Symbols from each place to its text's end mark.
        self.left = np.repeat(ends, sizes + 1) - np.arange(n)
        symbols = cell * 257 + sign
        order, lcp = self._sorted(sign, cell, int(sizes.max(initial=0)))
        before = symbols[order - 1]
        first = np.flatnonzero(np.diff(before, prepend=-1))
        last = np.append(first[1:], n) - 1
        self.first, self.last, self.symbol = first, last, before[first]
        self.at_first, self.at_last = order[first], order[last]
        by = np.argsort(self.symbol, kind="stable")
        length = (last - first + 1)[by]
        self.to = np.zeros(len(first), np.int64)
        self.to[by] = np.cumsum(length) - length
        #: Runs by (symbol, place), as one number, for the search of a symbol's next and last run.
        self.by, self.key = by, self.symbol[by] * (len(first) + 1) + by
        self.threshold = self._thresholds(lcp)

    def _sorted(self, sign: np.ndarray, cell: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order (of equal ones the earlier text's first), and what each shares with the one before."""
        n, left = len(sign), self.left

        def shifted(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[: max(0, n - by)] = x[by:]
            out[left < by] = 0  # beyond the end mark
            return out

        key = cell
        for k in range(4):
            key = key << 9 | shifted(sign, k)
        width, ranks = 4, []
        while True:
            order = np.argsort(key, kind="stable" if width > longest else None)
            s = key[order]
            new = np.concatenate([[False], s[1:] != s[:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) + 1
            ranks.append((width, rank))
            if width > longest or int(new.sum()) == n - 1:
                break
            key = rank * (n + 2) + shifted(rank, width)
            width *= 2
        # Pairs of neighbours go on by the widest equal step, then by single signs.
        x, y = order[:-1], order[1:]
        same = np.zeros(n, np.int64)
        for width, rank in reversed(ranks):
            i, j = x + same[1:], y + same[1:]
            ok = (left[x] > same[1:]) & (left[y] > same[1:])
            same[1:] += width * (ok & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)]))
        for _ in range(3):
            i, j = x + same[1:], y + same[1:]
            ok = (left[x] > same[1:]) & (left[y] > same[1:])
            same[1:] += ok & (sign[np.minimum(i, n - 1)] == sign[np.minimum(j, n - 1)])
        same[1:] = np.minimum(same[1:], np.minimum(left[x], left[y]))
        same[1:][cell[x] != cell[y]] = 0
        return order, same

    def _thresholds(self, lcp: np.ndarray) -> np.ndarray:
        """For each run in the order of key: where the least common prefix lies between the last run of its symbol and it."""
        value = lcp << 32 | np.arange(len(lcp))
        out = np.zeros(len(self.by), np.int64)
        pair = np.flatnonzero(self.symbol[self.by][1:] == self.symbol[self.by][:-1]) + 1
        if not len(pair):
            return out
        a, b = self.by[pair - 1] + 1, self.by[pair]  # whole runs between, then the first rank of b
        least = value[self.first[b]]
        level, done = np.minimum.reduceat(value, self.first), np.int64(1)
        while True:  # ranges of one to two steps of this width are two overlapping steps
            size = b - a
            own = (size >= done) & (size < 2 * done)
            least[own] = np.minimum(least[own], np.minimum(level[a[own]], level[b[own] - done]))
            if 2 * done > size.max(initial=0):
                break
            level = np.minimum(level[: len(level) - done], level[done:])
            done *= 2
        out[pair] = least & 0xFFFFFFFF
        return out

    def step(self, rank: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the suffix that best matches what follows, to the one that best matches symbol and what follows: its rank
        and its place (-1: the symbol occurs nowhere). Where the suffix's own run has another symbol, the match goes on
        from the end of the symbol's last run or from the start of its next one, whichever shares more. After a place of -1
        (as before the first symbol) nothing is matched yet, and any suffix, here the first, will do."""
        at = np.where(at < 0, self.at_first[0], at)
        run = np.searchsorted(self.first, rank, "right") - 1
        j = np.flatnonzero(self.symbol[run] != symbol)
        if len(j):
            many = len(self.by)
            next_ = np.searchsorted(self.key, symbol[j] * (many + 1) + run[j])
            after = next_ < many
            after[after] = self.symbol[self.by[next_[after]]] == symbol[j][after]
            ahead = next_ > 0
            ahead[ahead] = self.symbol[self.by[next_[ahead] - 1]] == symbol[j][ahead]
            back = ahead & (~after | (rank[j] < self.threshold[np.minimum(next_, many - 1)]))
            on = after & ~back
            run, rank, at = run.copy(), rank.copy(), at.copy()
            p, q = self.by[next_[back] - 1], self.by[next_[on]]
            run[j[back]], rank[j[back]], at[j[back]] = p, self.last[p], self.at_last[p]
            run[j[on]], rank[j[on]], at[j[on]] = q, self.first[q], self.at_first[q]
            none = j[~back & ~on]
        out, place = self.to[run] + rank - self.first[run], at - 1
        if len(j) and len(none):
            out[none], place[none] = 0, -1
        return out, place

    def stream(self, texts: list[bytes], cells: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Matching statistics of all texts side by side, from their ends: (texts, k, places) for their suffixes of k bytes,
        each with the place of a longest match among the indexed texts of its cell (-1: not even its first byte)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        base = np.asarray(cells, np.int64) * 257 + 1
        live = np.flatnonzero(sizes)
        rank, at = np.zeros(len(live), np.int64), np.full(len(live), -1, np.int64)
        for k in range(1, int(sizes.max(initial=0)) + 1):
            keep = sizes[live] >= k
            live, rank, at = live[keep], rank[keep], at[keep]
            rank, at = self.step(rank, at, base[live] + flat[ends[live] - k])
            yield live, k, at

    def windows(self, texts: list[bytes], cells: np.ndarray, depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """(text, start) of each window of depth (8 or more) bytes that an indexed text of the text's cell holds."""
        who, start, place = [], [], []
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        for live, k, at in self.stream(texts, cells):
            if k >= depth:
                ok = at >= 0
                ok[ok] = self.left[at[ok]] >= depth
                who.append(live[ok])
                start.append(sizes[live[ok]] - k)
                place.append(at[ok])
        if not who:
            return (np.zeros(0, np.int64),) * 2
        who, start, place = np.concatenate(who), np.concatenate(start), np.concatenate(place)
        mine = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
        here = (np.cumsum(sizes) - sizes)[who] + start
        words = lambda x: np.ndarray((len(x) - 7,), "<u8", np.ascontiguousarray(x).data, 0, (1,))
        a, b = words(mine), words(self.body)
        for shift in [depth - 8, *range(0, depth - 8, 8)]:  # the bytes themselves, eight at a time
            ok = a[here + shift] == b[place + shift]
            who, start, place, here = who[ok], start[ok], place[ok], here[ok]
        return who, start


def repeated(texts: list[bytes], group: np.ndarray, doc: np.ndarray, start: np.ndarray, depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, from, to) of runs of windows in texts[k] (bytes of doc[k] from start[k]) that begin earlier in another of its group.

    The texts of a group are numbered in order. Two of them are told apart by a highest bit of their numbers: the one
    with 0 there is earlier. So for each bit, the texts with 0 are indexed and those with 1 are streamed, in cells of
    the texts that agree in all higher bits.
    """
    order = np.lexsort((start, doc, group))
    head = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    number = np.empty(len(order), np.int64)
    at = np.arange(len(order))
    number[order] = at - np.maximum.accumulate(np.where(head, at, 0))
    dense = np.empty(len(order), np.int64)
    dense[order] = np.cumsum(head) - 1
    found = []
    for bit in range(int(number.max(initial=0)).bit_length()):
        _, cell = np.unique(dense << 32 | number >> (bit + 1), return_inverse=True)
        later = number >> bit & 1
        wanted = np.bincount(cell, later) > 0
        old, new = np.flatnonzero((later == 0) & wanted[cell]), np.flatnonzero(later)
        index = RunLengthIndex([texts[i] for i in old], cell[old])
        who, where = index.windows([texts[i] for i in new], cell[new], depth)
        found.append((doc[new[who]], start[new[who]] + where))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    d, s = (np.concatenate([f[k] for f in found]) for k in range(2))
    return spans(d, s, s + depth)


def spans(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of overlapping or touching [a, b) of each doc."""
    if not len(doc):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    top = b.copy()
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    # The running maximum of ends within a doc: shift each doc's values into a range of its own.
    group = np.cumsum(new) - 1
    big = int(b.max()) + 1
    top = np.maximum.accumulate(b + group * big) - group * big
    cut = new.copy()
    cut[1:] |= a[1:] > top[:-1]
    first = np.flatnonzero(cut)
    return doc[first], a[first], top[np.append(first[1:], len(doc)) - 1]


_MAPPED = "k long, doc long, at long, span long, context long"
_FOUND = "doc long, a long, b long, hash long"


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def _pieces(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc, bytes, offsets, place of each piece in its text) for column 0 and the texts in column 1."""
    doc = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    data, off = c.raw(c.fill(b.column(1)))
    if len(data) <= 2 * SWEEP:
        yield doc, data, off, np.zeros(len(doc), np.int64)
        return
    for k in range(len(doc)):
        for at in range(0, max(1, off[k + 1] - off[k] - WINDOW + 1), SWEEP):
            part = data[off[k] + at : min(off[k + 1], off[k] + at + SWEEP + WINDOW - 1)]
            yield doc[k : k + 1], part, np.array([0, len(part)]), np.array([at])


#: Low bits of span: at - first and at - last in 7 bits each. Above them the keys of both sides (0: no window).
_SPAN, _KEY = 14, 24


def _keys(data: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """span with the sides' keys."""
    out = (at - first) * 128 + (at - last)
    for side in range(2):
        lo, hi = side_starts(at, first, last, side)
        i = np.flatnonzero(lo <= hi)
        short = (side_key(data, at[i], side) >> np.uint64(64 - _KEY)).astype(np.int64)
        out[i] |= np.maximum(short, 1) << (_SPAN + _KEY * side)
    return out


@c.task
def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of (doc, text); those of equal contexts in one block are covered at once, but for the earliest."""
    for b in c.blocks(batches, limit=SWEEP):
        for doc, data, off, place in _pieces(b):
            x = anchors(data, off)
            if not len(x["at"]):
                continue
            shift = place[x["row"]] - off[x["row"]]
            d = doc[x["row"]]
            order = np.lexsort((x["at"] + shift, d, x["context"], x["hash"]))
            h, ctx = x["hash"][order], x["context"][order]
            head = np.concatenate([[True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])])
            i, j = order[head], order[~head]
            span = _keys(data, x["at"], x["first"], x["last"])
            yield _batch(["k", "doc", "at", "span", "context"], x["hash"][i].view(np.int64), d[i], (x["at"] + shift)[i], span[i], x["context"][i].view(np.int64))
            if len(j):
                dd, a, e = spans(d[j], (x["first"] + shift)[j], (x["last"] + shift)[j] + WINDOW)
                yield _batch(["k", "doc", "at", "span", "context"], c.mix(dd.astype(np.uint64) + a.astype(np.uint64)).view(np.int64), dd, a, np.full(len(dd), -1), e)


def _marked(k: np.ndarray, span: np.ndarray, group: int) -> np.ndarray:
    """For distinct contexts in the order of k: span without keys, and above it two bits for each side: 1 where another
    context of k has the side's key, 2 where more than group have it."""
    dense = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
    out = span & ((1 << _SPAN) - 1)
    for side in range(2):
        key = span >> (_SPAN + _KEY * side) & ((1 << _KEY) - 1)
        _, which, size = np.unique(dense << _KEY | key, return_inverse=True, return_counts=True)
        size = np.where(key > 0, size[which], 0)
        out |= ((size > 1) * np.where(size > group, 2, 1)) << (_SPAN + 2 * side)
    return out


def _group(group: int):
    """Rows of _sweep sorted by (k, context, doc, at). Out: covered spans (hash null), and of the first of each context of
    an anchor hash those that may share windows with another: (doc, at, span, hash), the span as _marked() has it."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        held = np.zeros((4, 0), np.int64)  # k, doc, at, span of the contexts of the last hash so far
        flood: int | None = None  # a hash with more contexts than are held
        everything = 2 << _SPAN | 2 << _SPAN + 2

        def out(x: np.ndarray, marked: np.ndarray) -> Iterator[pa.RecordBatch]:
            i = np.flatnonzero(marked >> _SPAN)
            if len(i):
                yield _batch(["doc", "a", "b", "hash"], x[1][i], x[2][i], marked[i], x[0][i])

        for b in batches:
            k, doc, at, span, ctx = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if not len(k):
                continue
            done = span < 0
            out_doc, out_a, out_b = [doc[done]], [at[done]], [ctx[done]]
            k, doc, at, span, ctx = k[~done], doc[~done], at[~done], span[~done], ctx[~done]
            if len(k):
                new = np.concatenate([[last != (k[0], ctx[0])], (k[1:] != k[:-1]) | (ctx[1:] != ctx[:-1])])
                last = k[-1], ctx[-1]
                old = ~new
                bits = span[old] & ((1 << _SPAN) - 1)
                out_doc.append(doc[old])
                out_a.append(at[old] - bits // 128)
                out_b.append(at[old] - bits % 128 + WINDOW)
                x = np.stack([k[new], doc[new], at[new], span[new]])
                if flood is not None:
                    n = int(np.searchsorted(x[0], flood, "right"))
                    yield from out(x[:, :n], x[3, :n] & ((1 << _SPAN) - 1) | everything)
                    flood, x = flood if n == x.shape[1] else None, x[:, n:]
                x = np.concatenate([held, x], 1)
                n = int(np.searchsorted(x[0], x[0, -1])) if x.shape[1] else 0
                held = x[:, n:].copy()
                if n:
                    yield from out(x[:, :n], _marked(x[0, :n], x[3, :n], group))
                if held.shape[1] > HELD:
                    yield from out(held, held[3] & ((1 << _SPAN) - 1) | everything)
                    flood, held = int(held[0, 0]), held[:, :0]
            d, a, e = np.concatenate(out_doc), np.concatenate(out_a), np.concatenate(out_b)
            if len(d):
                d, a, e = spans(d, a, e)
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(e), pa.nulls(len(d), pa.int64())], ["doc", "a", "b", "hash"])
        if held.shape[1]:
            yield from out(held, _marked(held[0], held[3], group))

    return run


_CONTEXT = "k long, kind int, doc long, a long, b long, hash long, body binary"


def _contexts(shards: int):
    """Rows (doc, text, list of (at, span, hash)): the bytes of the contexts' sides for the shards, or hashes of windows."""

    names = [f.split()[0] for f in _CONTEXT.split(", ")]

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches, limit=SWEEP):
            lists = b.column(2)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            need = lists.flatten()
            at, span, h = (need.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            row = np.repeat(np.arange(b.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            data, off = c.raw(c.fill(b.column(1)))
            bits = span & ((1 << _SPAN) - 1)
            sides = []
            for side in range(2):
                how = span >> (_SPAN + 2 * side) & 3
                lo, hi = side_starts(at, at - bits // 128, at - bits % 128, side)
                i = np.flatnonzero((how > 0) & (lo <= hi))
                key = c.mix(h[i].view(np.uint64) ^ side_key(data, off[row[i]] + at[i], side) + np.uint64(side))
                sides.append((row[i], lo[i], hi[i], key.view(np.int64), how[i] == 2))
            row, first, last, key, large = (np.concatenate(x) for x in zip(*sides, strict=True))
            doc = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[row]
            i = np.flatnonzero(~large)
            lo, hi = (off[row] + first).tolist(), (off[row] + last + WINDOW).tolist()
            whole = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array((c.mix(key[i].view(np.uint64)) % np.uint64(shards)).astype(np.int64)), pa.array(np.ones(len(i), np.int32)), pa.array(doc[i]), pa.array(first[i]), pa.array(last[i]), pa.array(key[i]), pa.array([whole[lo[j] : hi[j]] for j in i.tolist()], pa.binary())],
                names,
            )
            j = np.flatnonzero(large)
            if len(j):
                size = (last - first + 1)[j]
                start = np.repeat(first[j], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                own = np.repeat(j, size)
                base = off[row][own] + start
                w, w2 = (c.span_hash(data, base, base + WINDOW, which) for which in range(2))
                order = np.lexsort((start, doc[own], w2, w))
                head = np.concatenate([[True], (w[order][1:] != w[order][:-1]) | (w2[order][1:] != w2[order][:-1])])
                p, q = order[head], order[~head]
                null = pa.nulls
                yield pa.RecordBatch.from_arrays([pa.array(w[p].view(np.int64)), pa.array(np.full(len(p), 2, np.int32)), pa.array(doc[own][p]), pa.array(start[p]), pa.array(start[p] + WINDOW), pa.array(w2[p].view(np.int64)), null(len(p), pa.binary())], names)
                d, a, e = spans(doc[own][q], start[q], start[q] + WINDOW)
                yield pa.RecordBatch.from_arrays([pa.array(c.mix(d.astype(np.uint64) + a.astype(np.uint64)).view(np.int64)), pa.array(np.zeros(len(d), np.int32)), pa.array(d), pa.array(a), pa.array(e), null(len(d), pa.int64()), null(len(d), pa.binary())], names)

    return run


@c.task
def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _contexts sorted by (kind, k, hash, doc, a): covered spans."""
    now, docs, starts, keys, texts = None, [], [], [], []
    last = None

    def flush() -> pa.RecordBatch | None:
        if len(texts) < 2:
            return None
        return _batch(["doc", "a", "b"], *repeated(texts, np.array(keys, np.int64), np.array(docs, np.int64), np.array(starts, np.int64)))

    for b in batches:
        k, kind, doc, a, e = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        zero = kind == 0
        if zero.any():
            yield _batch(["doc", "a", "b"], doc[zero].astype(np.int64), a[zero], e[zero])
        one = np.flatnonzero(kind == 1)
        if len(one):
            rows = b.take(pa.array(one))
            for shard, d, at, key, text in zip(*(rows.column(i).to_pylist() for i in (0, 2, 3, 5, 6)), strict=True):
                if shard != now:
                    if (out := flush()) is not None:
                        yield out
                    now, docs, starts, keys, texts = shard, [], [], [], []
                docs.append(d)
                keys.append(key)
                starts.append(at)
                texts.append(text)
        two = np.flatnonzero(kind == 2)
        if len(two):
            w, w2 = k[two], b.column(5).take(pa.array(two)).to_numpy(zero_copy_only=False)
            again = np.concatenate([[last == (w[0], w2[0])], (w[1:] == w[:-1]) & (w2[1:] == w2[:-1])])
            last = w[-1], w2[-1]
            if again.any():
                yield _batch(["doc", "a", "b"], *spans(doc[two][again], a[two][again], e[two][again]))
    if (out := flush()) is not None:
        yield out


@c.task
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, list of (a, b) or null): what the removal leaves."""
    for b in c.blocks(batches, limit=SWEEP):
        out = []
        data, off = c.raw(c.fill(b.column(1)))
        whole = data.tobytes()
        for i, covered in enumerate(b.column(2).to_pylist()):
            text = whole[off[i] : off[i + 1]]
            removed = runs = at = 0
            kept = hashlib.sha256()
            end = -1
            for x in sorted((y["a"], y["b"]) for y in covered or ()):
                if x[0] > end:
                    runs += 1
                    kept.update(text[at : x[0]])
                    removed += x[1] - x[0]
                    end = x[1]
                elif x[1] > end:
                    removed += x[1] - end
                    end = x[1]
                at = end
            kept.update(text[at:])
            out.append((len(text), removed, runs, kept.hexdigest()))
        n, r, s, h = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(h)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and doc, a unique long in the order of doc_id. Only where ids repeat or are null is a sort needed:
    rows then go by (doc_id, text), nulls first."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = docs.select("doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        return docs.withColumn("doc", F.col("doc_id"))
    return c.cut(docs.orderBy("doc_id", "text").withColumn("doc", F.monotonically_increasing_id()), "keys")


def covered(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc, a, b: spans whose union is what docs (doc, text; doc unique) repeat of earlier bytes."""
    spark = docs.sparkSession
    n = max(c.parts_for(docs, 8), int(spark.conf.get("spark.sql.shuffle.partitions")))
    swept = docs.select("doc", "text").mapInArrow(_sweep, _MAPPED)
    found = c.cut(swept.repartition(n, "k").sortWithinPartitions("k", "context", "doc", "at").mapInArrow(_group(group), _FOUND), "anchors")
    need = found.where("hash IS NOT NULL")
    shards = max(1, need.count() * 135 // SHARD_BYTES)
    lists = need.groupBy("doc").agg(F.collect_list(F.struct(F.col("a").alias("at"), F.col("b").alias("span"), "hash")).alias("need"))
    context = docs.select("doc", "text").join(lists, "doc").select("doc", "text", "need").mapInArrow(_contexts(shards), _CONTEXT)
    more = context.repartition(n, "k").sortWithinPartitions("kind", "k", "hash", "doc", "a").mapInArrow(_shards, "doc long, a long, b long")
    return found.where("hash IS NULL").select("doc", "a", "b").unionByName(more)


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row: its text without each byte that is covered by a
    100-byte string which also begins earlier (in a smaller doc_id, or the same text before).

    A null text is empty. Rows with one id are ordered by their texts (equal rows in any order), null ids come first.
    """
    docs = with_keys(docs)
    lists = covered(docs, group).groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("covered"))
    joined = docs.select("doc", "text").join(lists, "doc", "left")
    ids = docs.select("doc", "doc_id") if docs.columns[-1] == "doc" and "doc_id" in docs.columns else None
    out = joined.select("doc", "text", "covered").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if getattr(docs, "_cartolex_path", None):  # keys of their own
        return out.withColumnRenamed("doc_id", "doc").join(ids, "doc").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return out


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(c.table(spark, sf_dir, "documents"))
