"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

One pass over the texts turns each into a row of statistics. Labelled rows meet their statistics in a join of narrow
rows; each partition sums its normal equations (a matrix of fixed size), and the sums are added in a tree. The ridge
scores of the labelled rows, counted in bins of fixed number, give the isotonic curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Random features, and the ridge penalty on the mean squared weight.
FEATURES, RIDGE = 256, 1e-3
#: Bins of ridge scores that the isotonic curve is fitted on.
BINS = 2000
THRESHOLD = 0.3
RANDOM_SEED = 7
#: Fixed groups of characters whose shares are statistics.
GROUPS = ("!", "%$&#*@^~", "|", ".", ",", ";:", "?", "-_/\\+=<>", "()[]{}", "\"'`")
STATISTICS = 16 + len(GROUPS)

_group = np.zeros(256, np.int64)
for _k, _chars in enumerate(GROUPS):
    _group[list(_chars.encode())] = 1 + _k
_kind = np.zeros(256, np.int64)
_kind[ord("a") : ord("z") + 1] = 1
_kind[ord("A") : ord("Z") + 1] = 2
_kind[ord("0") : ord("9") + 1] = 3
_kind[128:] = 4


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of distinct h, and the largest count of one of them."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])])
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(r)))
    most = np.zeros(n)
    np.maximum.at(most, r[at], sizes)
    return np.bincount(r[at], minlength=n).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS numbers for each text, all of its bytes counted; an empty text is all zeros."""
    n = len(texts)
    data, off = c.raw(texts)
    size = np.diff(off).astype(float)
    row = np.repeat(np.arange(n), np.diff(off))
    share = lambda count, of: np.divide(count, of, out=np.zeros(n), where=of > 0)
    kinds = np.bincount(row * 5 + _kind[data], minlength=5 * n).reshape(n, 5).astype(float)
    groups = np.bincount(row * (len(GROUPS) + 1) + _group[data], minlength=(len(GROUPS) + 1) * n).reshape(n, -1)[:, 1:].astype(float)
    start, end, wrow = c.runs(~c.SPACE[data], off)
    words = np.bincount(wrow, minlength=n).astype(float)
    length = (end - start).astype(float)
    word = c.span_hash(c.LOWER[data], start, end)
    same = np.zeros(len(word))
    if len(word):
        same[1:] = (word[1:] == word[:-1]) & (wrow[1:] == wrow[:-1])
    kinds_of_words, most = _distinct(wrow, word, n)
    l0, l1, lrow = c.runs(data != 10, off)
    lines = np.bincount(lrow, minlength=n).astype(float)
    kinds_of_lines, _ = _distinct(lrow, c.span_hash(data, l0, l1), n)
    by_word = lambda v: share(np.bincount(wrow, v, n), words)
    mean = by_word(length)
    first = _kind[data[start]] if len(start) else np.zeros(0, np.int64)
    last = _group[data[end - 1]] if len(end) else np.zeros(0, np.int64)
    columns = [
        np.log1p(size),
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(by_word(length**2) - mean**2, 0)),
        share(kinds[:, 2], kinds[:, 1] + kinds[:, 2]),
        share(kinds[:, 3], size),
        share(kinds[:, 4], size),
        share(words, size),
        share(kinds_of_words, words) * np.log1p(words),
        share(most, words),
        by_word(same),
        share(lines, words),
        share(lines - kinds_of_lines, lines),
        by_word((length > 20).astype(float)),
        by_word((first == 2).astype(float)),
        by_word((last > 0).astype(float)),
        *(np.sqrt(share(g, size)) for g in groups.T),
    ]
    return np.stack(columns, 1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of STATISTICS floats) for every row; a null text is empty."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches):
            x = statistics(c.fill(b.column(1))).astype(np.float32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, STATISTICS, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<float>")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, STATISTICS)


class Model:
    """Standardising, random Fourier features, ridge weights, isotonic curve."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int = FEATURES, seed: int = RANDOM_SEED) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, std
        # The kernel's width is the square root of the dimension: about the distance of two standardised rows.
        self.w = rng.normal(size=(STATISTICS, features)) / np.sqrt(STATISTICS)
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.curve = (np.array([0.0]), np.array([0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        return np.concatenate([np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1]), np.ones((len(x), 1))], 1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(x), *self.curve), 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing values closest to mean in weighted squares, by pooling adjacent violators; at is sorted."""
    value, size, span = [], [], []
    for m, w in zip(mean.tolist(), weight.tolist(), strict=True):
        value.append(m)
        size.append(w)
        span.append(1)
        while len(value) > 1 and value[-2] >= value[-1]:
            m, w, k = value.pop(), size.pop(), span.pop()
            value[-1] = (value[-1] * size[-1] + m * w) / (size[-1] + w)
            size[-1] += w
            span[-1] += k
    return np.repeat(value, span)


def fit(labelled: DataFrame) -> Model | None:
    """A model from (x, y, fold long); rows of fold 1 fit the isotonic curve, the others the ridge. None without rows."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            if b.num_rows:
                yield _matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for x, _ in batches_of(batches):
            v = np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
            total = v if total is None else total + v
        return total

    m = c.tree_sum(c.per_partition(labelled.select("x", "y"), moments), "f8")
    if m is None:
        return None
    mean = m[1 : 1 + STATISTICS] / m[0]
    std = np.sqrt(np.maximum(m[1 + STATISTICS :] / m[0] - mean**2, 1e-12))
    model = Model(mean, np.where(std > 1e-5, std, 1.0))
    k = len(model.weights)

    def normal(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for x, y in batches_of(batches):
            f = model.features(x)
            v = np.concatenate([(f.T @ f).ravel(), f.T @ y, [len(y)]])
            total = v if total is None else total + v
        return total

    s = c.tree_sum(c.per_partition(labelled.where("fold <> 1").select("x", "y"), normal), "f8")
    if s is not None:
        penalty = RIDGE * s[-1] / FEATURES * np.eye(k)
        penalty[-1, -1] = 1e-9
        model.weights = np.linalg.solve(s[: k * k].reshape(k, k) + penalty, s[k * k : -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = np.zeros(2 * BINS)
        for x, y in batches_of(batches):
            at = np.clip(((model.ridge(x) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            total += np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])
        return total

    held = labelled.where("fold = 1")
    t = c.tree_sum(c.per_partition(held.select("x", "y"), binned), "f8")
    if t is None or not t.any():
        t = c.tree_sum(c.per_partition(labelled.select("x", "y"), binned), "f8")
    full = np.flatnonzero(t[:BINS])
    at = (full + 0.5) / BINS * 2 - 0.5
    model.curve = (at, isotonic(at, t[BINS:][full] / t[full], t[full]))
    return model


def score(stats: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of document_statistics(). Without a model every score is 0.5."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(_matrix(b.column(1))) if model is not None and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, held: int = 5, threshold: float = THRESHOLD, stats: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs, learned from labels (doc_id, quality).

    Rows whose crc32 of the id modulo held is 0 are never learned from; those with 1 calibrate. Labels that are null or
    of no document count nothing, repeated ones count as often as they match. Null and empty texts are scored as such.
    """
    stats = stats if stats is not None else c.cut(document_statistics(docs), "statistics")
    y = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    fold = c.crc_mod("doc_id", held)
    known = stats.join(y, "doc_id").withColumn("fold", fold).where("fold <> 0").select("x", "y", "fold")
    model = fit(c.cut(known, "labelled"))
    return score(stats, model, threshold).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "labels"))
