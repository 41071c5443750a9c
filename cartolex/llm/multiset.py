"""Homomorphic multiset fingerprints of documents.

A paragraph (a non-blank line, without the white space around it) becomes a wide vector: four 64-bit lanes, which are
the 256 bits of its BLAKE2b digest, and 128 signed 16-bit counters to which each pair of neighbouring words adds plus or
minus one.
A document is the sum of its paragraphs' vectors modulo 2**64 and 2**16. Order does not matter, equal multisets have
equal sums, and a paragraph is put in or taken out by adding or subtracting its vector, without the other paragraphs.
The lanes decide equality; the counters, as a sketch, give the likeness of two documents by their cosine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

LANES, COUNTERS = 4, 128
#: Slices of the id range at most; with more input each is longer, and is still read as a stream.
SLICES = 65_536
_NEWLINE = ord("\n")


class Vectors:
    """n sums, side by side."""

    def __init__(self, n: int) -> None:
        self.lanes = np.zeros((n, LANES), np.uint64)
        self.counters = np.zeros((n, COUNTERS), np.int16)

    def __iadd__(self, other: Vectors) -> Vectors:
        with np.errstate(over="ignore"):
            self.lanes += other.lanes
            self.counters += other.counters
        return self

    def __isub__(self, other: Vectors) -> Vectors:
        with np.errstate(over="ignore"):
            self.lanes -= other.lanes
            self.counters -= other.counters
        return self

    def copy(self) -> Vectors:
        out = Vectors(0)
        out.lanes, out.counters = self.lanes.copy(), self.counters.copy()
        return out

    def hex(self) -> list[str]:
        return [a.astype(">u8").tobytes().hex() + b.astype(">i2").tobytes().hex() for a, b in zip(self.lanes, self.counters, strict=True)]


def vectors(texts: list[str]) -> Vectors:
    """The sum of each text's paragraphs."""
    out = Vectors(len(texts))
    data, off = c.raw(pa.array(texts, pa.large_string()))
    solid = ~c.SPACE[data]
    start, end, row = c.runs(data != _NEWLINE, off)
    w0, w1, wrow = c.runs(solid, off)
    if not len(w0):
        return out
    # A paragraph goes from its first word's start to its last word's end.
    first, last = np.searchsorted(w0, start), np.searchsorted(w0, end) - 1
    full = first <= last
    first, last, row = first[full], last[full], row[full]
    whole = data.tobytes()
    digest = b"".join([blake2b(whole[a:b], digest_size=8 * LANES).digest() for a, b in zip(w0[first].tolist(), w1[last].tolist(), strict=True)])
    with np.errstate(over="ignore"):
        np.add.at(out.lanes, row, np.frombuffer(digest, "<u8").reshape(-1, LANES))
        word = c.span_hash(data, w0, w1)
        head = np.zeros(len(w0), bool)
        head[first] = True
        before = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
        before[head] = 1
        pair = c.mix(word + before * np.uint64(3))
    at = wrow * COUNTERS + (pair % np.uint64(COUNTERS)).astype(np.int64)
    sign = ((pair >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    sums = np.bincount(at, sign, len(texts) * COUNTERS).astype(np.int64)
    out.counters += sums.reshape(-1, COUNTERS).astype(np.int16)
    return out


def likeness(a: Vectors, b: Vectors) -> np.ndarray:
    """From 0 to 1: 1 for equal sums, else the sketches' cosine where that is above 0."""
    x, y = a.counters.astype(np.float64), b.counters.astype(np.float64)
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cos = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where((a.lanes == b.lanes).all(1), 1.0, np.clip(cos, 0, 1))


def _edit(text: str, after: str) -> tuple[str, str, str, str]:
    """The edited text, and what differs: the paragraphs taken out, put in, and the edited text's place of change."""
    n = len(text) // 4
    keep = text[: len(text) - n]
    at = keep.rfind("\n") + 1
    put = after[:n]
    return keep + put, text[at:], keep[at:] + put, keep


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all texts but the last, each with the text after it."""
    edits = [_edit(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own = vectors(texts)
    new = Vectors(0)
    new.lanes, new.counters = own.lanes[:-1].copy(), own.counters[:-1].copy()
    new -= vectors([x[1] for x in edits])
    new += vectors([x[2] for x in edits])
    here, after = Vectors(0), Vectors(0)
    here.lanes, here.counters, after.lanes, after.counters = own.lanes[:-1], own.counters[:-1], own.lanes[1:], own.counters[1:]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(x[0].encode("utf-8", "surrogatepass")).hexdigest() for x in edits], pa.string()),
            pa.array(here.hex(), pa.string()),
            pa.array(new.hex(), pa.string()),
            pa.array(likeness(here, new)),
            pa.array(likeness(here, after)),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


@c.task
def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice, then document; a slice's last row is the head of the next slice and only ends it."""
    ids, texts, now, size = [], [], None, 0
    for b in batches:
        for s, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
            text = text or ""
            if s != now:
                if len(texts) > 1:
                    yield _rows(ids, texts)
                ids, texts, now, size = [], [], s, 0
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if size > c.BLOCK_BYTES:
                if len(texts) > 1:
                    yield _rows(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(text)
                if size > c.BLOCK_BYTES:
                    size = 0
    if len(texts) > 1:
        yield _rows(ids, texts)


def _interval(cuts: list[int]):
    """How many of the sorted cuts are below column k: first among every hundredth or so, then among those between."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    text = lambda xs: f"array({', '.join(f'CAST({x} AS LONG)' for x in xs)})"
    tops = text([g[0] for g in groups])
    inner = f"array({', '.join(text(g) for g in groups)})"
    top = f"size(filter({tops}, x -> k > x))"
    return F.expr(f"CASE WHEN {top} = 0 THEN 0 ELSE ({top} - 1) * {step} + size(filter({inner}[{top} - 1], x -> k > x)) END")


def fingerprint_documents(docs: DataFrame, slice_mb: int = 4) -> DataFrame:
    """FIELDS for every row: its fingerprint, that of its edited text, and its likeness to that and to the next row.

    The next row is the one after it by (doc_id, text), null ids first; after the last comes the first. A null text is
    empty. Rows are dealt to slices of the id range; each slice also gets the first row of the next one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    # As many slices as the shuffle has tasks, or more where the bytes ask for it.
    slices = min(max(c.parts_for(docs, slice_mb), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), SLICES)
    cuts = docs.select(key.alias("k")).approxQuantile("k", [i / slices for i in range(1, slices)], 0.1 / slices) if slices > 1 else []
    cuts = sorted({int(x) for x in cuts})
    # Slice i has the keys above cuts[i-1], up to cuts[i].
    number = _interval(cuts)
    placed = docs.withColumn("k", key).withColumn("slice", number.cast("int"))
    # One head for each slice that has rows: as many as slices. Only ids are read.
    heads = sorted((r["slice"], r["k"]) for r in docs.select(key.alias("k")).withColumn("slice", number.cast("int")).groupBy("slice").agg(F.min("k").alias("k")).collect())
    if not heads:
        return docs.sparkSession.createDataFrame([], FIELDS)
    before = {k: heads[i - 1][0] for i, (_, k) in enumerate(heads)}
    lead = docs.sparkSession.createDataFrame([(k, s) for k, s in before.items()], "head long, ends int")
    # Of the rows that share a head's id, the smallest text is the head; the slice before gets it alone.
    first = placed.join(F.broadcast(lead), placed["k"] == lead["head"]).groupBy("ends", "k").agg(F.min("text").alias("text"))
    tail = first.select(F.col("ends").alias("slice"), F.lit(None).cast("long").alias("doc_id"), F.lit(1).alias("last"), "text", "k")
    rows = placed.select("slice", "doc_id", F.lit(0).alias("last"), "text", "k").unionByName(tail)
    rows = rows.repartition(max(slices, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "slice").sortWithinPartitions("slice", "last", "k", "text")
    return rows.select("slice", "doc_id", "last", "text").mapInArrow(_sweep, FIELDS)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(c.table(spark, sf_dir, "documents"))
