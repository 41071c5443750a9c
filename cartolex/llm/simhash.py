"""Near-duplicates by 64-bit SimHash fingerprints, searched in BK-trees.

Rows with one fingerprint form a class, so that copies cost nothing further. Two fingerprints within the radius agree
on all but `radius` of their blocks, so classes are dealt to shards by the leading bits of the blocks that agree: any two
within the radius meet in some shard, whatever the shard's size. Shards are coarse (some hundreds of fingerprints), and
each has one BK-tree (children keyed by their Hamming distance to the parent), which is searched along the edges within
the radius; a shard of more than CHUNK fingerprints has a tree for each CHUNK of them. A tree meets the rows that query
it by a shuffle. It is not broadcast: all trees together hold the fingerprints of all documents, which no driver may
gather. What leaves a shard is a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .components import UnionFind, components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a BK-tree at most; larger shards are cut into so many and each pair of them is one unit of work.
CHUNK = 1024
#: Fingerprints that a shard of random ones holds, about.
SHARD = 512


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit integer: bit k is 1 if it is set in over half the shingles' XXH64.

    Words are what lies between white space of ASCII, with A-Z in lower case; shingles are space-joined and count as
    often as they occur. Fewer words than a shingle make one shingle of all; no word gives 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        set_bits += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def text_hash():
    """A text's own hash as a column, by which its rows are found again; a null text is an empty one."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp for every row; a null text is an empty one."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([fingerprint(t or "", shingle) for t in b.column(2).to_pylist()], pa.int64())], ["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, fp long")


class BKTree:
    """A tree of integers under Hamming distance: a child hangs at the edge of its distance to its parent."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if not d:
                return
            below = node[1].get(d)
            if below is None:
                node[1][d] = [value, {}]
                return
            node = below

    def within(self, value: int, radius: int) -> list[int]:
        """The tree's values at that distance or less."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            d = (node[0] ^ value).bit_count()
            if d <= radius:
                found.append(node[0])
            if node[1]:
                if len(node[1]) <= 2 * radius + 1:
                    todo += [x for k, x in node[1].items() if abs(k - d) <= radius]
                else:
                    todo += [x for k in range(d - radius, d + radius + 1) if (x := node[1].get(k))]
        return found


def blocks_for(distinct: int, radius: int = RADIUS) -> tuple[int, int, int]:
    """(blocks, blocks that must agree, leading bits of each that count): as few agreeing blocks as leave SHARD random
    fingerprints in a shard or fewer, and no more of their bits than that takes."""
    wanted = max(0, (distinct // SHARD).bit_length() - 1)
    agree = 1
    while agree < 4 and 64 * agree // (agree + radius) < wanted:
        agree += 1
    return agree + radius, agree, min(-(-wanted // agree), 64 // (agree + radius))


def shard_keys(fp: str, blocks: int, agree: int, bits: int):
    """An array of shard keys of a fingerprint: a hash of each choice of blocks with the leading bits of their values."""
    if not bits:
        return F.array(F.lit(0).cast("long"))
    ends = [round(64 * k / blocks) for k in range(1, blocks + 1)]
    part = [F.shiftrightunsigned(F.col(fp), end - bits).bitwiseAND(F.lit((1 << bits) - 1)) for end in ends]
    return F.array(*[F.xxhash64(F.lit(k), *[part[i] for i in chosen]) for k, chosen in enumerate(itertools.combinations(range(blocks), agree))])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _search(radius: int):
    """Links of each unit (shard, tree chunk): its rows with side 0 form the tree; all rows query it."""

    def close(sets: UnionFind, tree: BKTree, own: list[int], other: list[int], out: list[tuple[int, int]]) -> None:
        for x in own:  # each new value queries those before it, then joins them
            for y in tree.within(x, radius):
                if sets.join(x, y):
                    out.append((x, y))
            tree.add(x)
        for x in other:
            for y in tree.within(x, radius):
                if sets.join(x, y):
                    out.append((x, y))

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, other, out = None, [], [], []

        def flush() -> None:
            if len(own) + len(other) > 1:
                close(UnionFind(), BKTree(), own, other, out)
            own.clear()
            other.clear()

        for b in batches:
            unit, side, fp = (b.column(k).to_pylist() for k in range(3))
            for u, s, x in zip(unit, side, fp, strict=True):
                if u != now:
                    flush()
                    now = u
                (other if s else own).append(x & 0xFFFFFFFFFFFFFFFF)
            if len(out) > 100_000:
                yield _pairs(out)
                out.clear()
        flush()
        yield _pairs(out)

    return run


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_signed(x[k]) for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def links(values: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """a, b: links between distinct fingerprints of values (fp long, distinct) that connect all within the radius."""
    keyed = values.select("fp", F.explode(shard_keys("fp", *blocks_for(values.count(), radius))).alias("shard"))
    sizes = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    big = sizes.where(F.col("n") > chunk).select(F.col("shard").alias("big_shard"), F.ceil(F.col("n") / chunk).cast("long").alias("chunks"))
    # At most (keys in all) / chunk shards are big.
    near = keyed.join(sizes.select("shard"), "shard", "left_semi").join(big, F.col("shard") == F.col("big_shard"), "left").drop("big_shard")
    own = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks"))
    # In a cut shard a fingerprint is in its own chunk's tree and queries those of the chunks before.
    to = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), own))
    units = near.select("fp", "shard", "chunks", F.explode(to).alias("tree"))
    units = units.select(F.xxhash64("shard", "tree").alias("unit"), F.when(F.col("chunks").isNull() | (F.col("tree") == own), 0).otherwise(1).alias("side"), "fp")
    units = units.repartition(max(c.parts_for(values, 4), int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "unit").sortWithinPartitions("unit", "side", "fp")
    return units.mapInArrow(_search(radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links of fingerprints reach, itself included.

    Null and empty texts have fingerprint 0 and link with each other like any. A null doc_id counts for no minimum; a
    component of null ids alone has a null component_id. Repeated rows are kept.
    """
    return labelled(docs, radius, shingle, chunk).select("doc_id", "fp", "component_id")


def labelled(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, chunk: int = CHUNK) -> DataFrame:
    """near_duplicates() with text_hash and label, which tells components apart that have one component_id."""
    each = c.cut(fingerprints(docs, shingle), "fp")
    classes = c.cut(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    joined = components(links(classes.select("fp"), radius, chunk))
    label = classes.join(joined, classes["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("label"))
    ids = label.groupBy("label").agg(F.min("least").alias("component_id"))
    return each.join(label.select("fp", "label").join(ids, "label").select("fp", "label", "component_id"), "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(c.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
