"""Anchors: for every 100-byte window of a text, the place of its least k-byte hash (the leftmost of equals).

Equal windows have their anchors at equal offsets, so windows need only be compared with those of the same anchor
hash. Neighbouring windows mostly share an anchor: there is about one for each 39 bytes.

The windows of an anchor have two sides: those that begin at least LEFT bytes before it, and the others. All windows of a
side hold some bytes more than the anchor, so equal windows also agree in their side's key, a hash of those bytes.
"""

from __future__ import annotations

import numpy as np

from . import common as c

WINDOW, K = 100, 24
#: k-byte hashes that a window holds.
SPAN = WINDOW - K + 1
#: Windows that begin at least so many bytes before their anchor are its left ones.
LEFT = SPAN // 2
#: From the anchor, the start of the bytes that all windows of a side hold, and how many they are.
SIDES = ((-LEFT, LEFT + K), (0, WINDOW - LEFT + 1))
#: Low bits of a sort key that hold the position in a block.
_AT = 24


def least_in_spans(key: np.ndarray, span: int) -> np.ndarray:
    """out[i] = min(key[i : i + span]), for each full span."""
    n = len(key) - span + 1
    if n <= 0:
        return key[:0]
    width, x = 1, key
    while 2 * width <= span:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[span - width : span - width + n])


def anchors(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors of all windows inside each text of a block (up to 16 MB in all).

    row, at (in the block), first and last (the range of window starts that have it), hash (of the k bytes) and
    context (hash of the bytes from the first window's start to the last one's end, and of the range).
    """
    n = len(data)
    if n < WINDOW:
        return {k: np.zeros(0, np.int64) for k in ("row", "at", "first", "last", "hash", "context")}
    start = np.arange(n - K + 1)
    h = c.gram_hash(data, K)
    key = (h >> np.uint64(_AT) << np.uint64(_AT)) | start.astype(np.uint64)
    of = (least_in_spans(key, SPAN) & np.uint64((1 << _AT) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(of)]
    inside = np.flatnonzero(np.arange(len(of)) + WINDOW <= off[row + 1])
    if not len(inside):
        return anchors(data[:0], off)
    at = of[inside]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    first, last = inside[new], inside[np.append(new[1:], len(inside)) - 1]
    at = at[new]
    with np.errstate(over="ignore"):
        context = c.mix(c.span_hash(data, first, last + WINDOW, 1) + ((at - first) * 128 + (at - last)).astype(np.uint64))
    return {"row": row[first], "at": at, "first": first, "last": last, "hash": h[at], "context": context}


def side_starts(at: np.ndarray, first: np.ndarray, last: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of one side of each anchor; the side has no window where the last is the smaller."""
    return (first, np.minimum(last, at - LEFT)) if side == 0 else (np.maximum(first, at - LEFT + 1), last)


def side_key(data: np.ndarray, at: np.ndarray, side: int) -> np.ndarray:
    """64-bit hashes of the bytes that all windows of a side of the anchors hold."""
    start, size = at + SIDES[side][0], SIDES[side][1]
    return c.hash_at(data, start, size)
