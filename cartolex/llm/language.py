"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become letters in lower case with one 0 for everything else; bigrams and trigrams of them are hashed to buckets.
Document frequencies count every training document. The weights are trained by follow-the-regularised-leader with an
elastic net on a bounded sample, then one temperature is fitted on the sampled rows set aside for it. TF is the share
of a document's n-grams, so that a score is the mean of one table row per n-gram, gathered over the whole text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

BUCKETS = 1 << 16
#: Documents that the weights are trained on, about (the sample is those with the smallest hashes of their ids).
SAMPLE = 4000
#: Follow-the-regularised-leader: step, smoothing, L1 and L2; passes over the sample; factor of the inputs.
ALPHA, BETA, L1, L2, PASSES, SCALE = 0.3, 1.0, 0.02, 0.01, 4, 30.0
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(k).isalpha() for k in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes of all texts with a 0 before, between and after them, and each text's start and end among them."""
    lower = [t.lower() for t in texts]
    size = np.fromiter(map(len, lower), np.int64, len(lower))
    x = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[x]
    end = np.cumsum(size + 1)
    return np.where(letter, x, 0), end - size, end


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of each bigram and trigram that holds a letter; and whether each text has a letter."""
    x, start, end = codes(texts)
    n = len(texts)
    who = np.repeat(np.arange(n), end - start + 1)  # the 0 before a text is its own; the one after it, the next one's
    if not n:
        return who, who, np.zeros(0, bool)
    with np.errstate(over="ignore"):
        h = x.astype(np.uint32) * np.uint32(0x9E3779B1)
        two = (h[:-1] ^ (h[1:] * np.uint32(5) + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (h[2:] * np.uint32(31) + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
    letter = x > 0
    pair = letter[:-1] | letter[1:]
    a = np.flatnonzero(pair)
    b = np.flatnonzero((pair[:-1] | letter[2:]) & (np.arange(2, len(x)) <= end[who[:-1]]))
    bucket = np.concatenate([two[a] >> np.uint32(16), three[b] >> np.uint32(16)]).astype(np.int64)
    has = np.bincount(who[letter[:-1]], minlength=n) > 0
    return np.concatenate([who[a], who[b]]), bucket, has


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(BUCKETS + 1, np.int64)
        for b in c.blocks(batches, limit=1 << 19):
            rows, bucket, _ = grams(c.fill(b.column(0)).to_pylist())
            once = np.unique(rows * BUCKETS + bucket) % BUCKETS
            total[:BUCKETS] += np.bincount(once, minlength=BUCKETS)
            total[BUCKETS] += b.num_rows
        return total

    v = c.tree_sum(c.per_partition(docs.select("text"), count), "i8")
    return (np.zeros(BUCKETS, np.int64), 0) if v is None else (v[:BUCKETS], int(v[BUCKETS]))


class Model:
    """Languages, the table of idf times weights (a row per bucket), biases and temperature."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.langs, self.table, self.bias, self.temperature = langs, table.astype(np.float32), bias, temperature

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row per text, and whether the text has a letter."""
        rows, bucket, has = grams(texts)
        n, k = len(texts), len(self.langs)
        size = np.maximum(np.bincount(rows, minlength=n), 1)
        z = np.stack([np.bincount(rows, self.table[bucket, j], n) for j in range(k)], 1) / size[:, None] * SCALE + self.bias
        return softmax(z / self.temperature), has


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(at: list[np.ndarray], tf: list[np.ndarray], y: np.ndarray, n_langs: int, idf: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, biases and temperature from sparse rows; every fifth row only fits the temperature."""
    z, n = np.zeros((BUCKETS + 1, n_langs)), np.zeros((BUCKETS + 1, n_langs))
    eye = np.eye(n_langs)
    rows = [(np.append(a, BUCKETS), np.append(t * idf[a] * SCALE, 1.0)) for a, t in zip(at, tf, strict=True)]
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 10 else np.zeros(len(rows), bool)
    fitted = np.flatnonzero(~held)

    def weights(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) <= L1, 0.0, (np.sign(zz) * L1 - zz) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(fitted):
            a, x = rows[i]
            w = weights(z[a], n[a])
            g = x[:, None] * (softmax((x @ w)[None])[0] - eye[y[i]])
            m = n[a] + g * g
            z[a] += g - (np.sqrt(m) - np.sqrt(n[a])) / ALPHA * w
            n[a] = m
    w = weights(z, n)
    check = np.flatnonzero(held) if held.any() else fitted
    logits = np.stack([rows[i][1] @ w[rows[i][0]] for i in check]) if len(check) else np.zeros((0, n_langs))
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.2, 5, 65):
        loss = -np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).sum()
        if loss < best:
            best, temperature = loss, float(t)
    return w[:BUCKETS], w[BUCKETS], temperature


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of the training rows docs (doc_id, text, lang without nulls). None without rows."""
    df, n = frequencies(docs)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    share = min(1.0, sample / n)
    h = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    chosen = docs.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else docs

    @c.task
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches, limit=1 << 19):
            rows, bucket, _ = grams(c.fill(b.column(b.schema.get_field_index("text"))).to_pylist())
            key, count = np.unique(rows * BUCKETS + bucket, return_counts=True)
            cut = np.searchsorted(key, np.arange(b.num_rows + 1) * BUCKETS)
            size = np.maximum(np.bincount(rows, minlength=b.num_rows), 1)
            at = [(key[i:j] % BUCKETS).astype("<u2").tobytes() for i, j in zip(cut, cut[1:], strict=False)]
            tf = [(count[i:j] / s).astype("<f4").tobytes() for i, j, s in zip(cut, cut[1:], size, strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("lang")), pa.array(at, pa.binary()), pa.array(tf, pa.binary())], ["doc_id", "lang", "at", "tf"])

    def learn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "lang"], kind="stable")
        langs = sorted(set(g["lang"]))
        y = g["lang"].map({v: k for k, v in enumerate(langs)}).to_numpy()
        w, bias, t = train([np.frombuffer(v, "<u2").astype(np.int64) for v in g["at"]], [np.frombuffer(v, "<f4").astype(float) for v in g["tf"]], y, len(langs), idf)
        return pd.DataFrame({"lang": langs, "w": [w[:, k].astype("<f4").tobytes() for k in range(len(langs))], "bias": bias, "t": t})

    rows = chosen.select("doc_id", "text", "lang").mapInArrow(sparse, "doc_id long, lang string, at binary, tf binary").withColumn("one", F.lit(1)).groupBy("one").applyInPandas(learn, "lang string, w binary, bias double, t double").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["lang"])
    table = np.stack([np.frombuffer(r["w"], "<f4") for r in rows], 1) * idf[:, None]
    return Model([r["lang"] for r in rows], table, np.array([r["bias"] for r in rows]), rows[0]["t"])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score for every row. A text without a letter (null, empty) is und with score 0."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in c.blocks(batches, limit=1 << 19):
            if model is None:
                lang, score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            else:
                p, has = model.probabilities(c.fill(b.column(1)).to_pylist())
                best = p.argmax(1)
                lang = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, has, strict=True)]
                score = np.where(has, p.max(1), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, by: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text, lang).

    It learns from text and lang of the rows with a lang whose crc32 of the id modulo by is not held.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    own = c.crc_mod("doc_id", by) == held
    model = fit(docs.where(~own & F.col("lang").isNotNull() & F.col("text").isNotNull()), sample)
    return predict(docs, model).select("doc_id", own.alias("held_out"), "lang_pred", "score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(c.table(spark, sf_dir, "documents"))
