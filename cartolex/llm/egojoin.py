"""Embedding near-duplicates: an epsilon grid order join.

Unit vectors with a cosine of t are sqrt(2 - 2t) apart: epsilon. Vectors are turned to the principal axes of a bounded
sample (a rotation, so distances stay). The vectors of each label are put in epsilon grid order, which is that of their
grid cells of width epsilon on the leading axes, by one global sort, and the sequence is cut into blocks of bounded size,
each with its box on these axes. Boxes meet boxes first (one row a block): only pairs of blocks whose boxes are within
epsilon become units of work, to which their vectors are sent. A unit joins its two sorted sequences recursively and
skips halves whose boxes are further apart. Equal vectors form one class, so copies cost nothing further, and a unit
returns counts and a spanning forest of its links rather than pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c
from .components import UnionFind, components

THRESHOLD = 0.93
#: Vectors that the principal axes are fitted on, about; any axes give the same result.
SAMPLE = 20_000
#: Leading axes that order and prune; vectors of a block; vectors of a sequence that is not halved further.
AXES, BLOCK, LEAF = 8, 1024, 128
#: Added to epsilon against rounding.
SLACK = 1e-6


def _floats(kind: T.DataType) -> str:
    return "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"


def _prepare(vectors: DataFrame, dtype: str) -> DataFrame:
    """vec_id, label, v: the components' bytes, null where the vector cannot link."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for label, x in zip(b.column(2).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), strict=True):
                v = None
                if label is not None and x is not None and len(x):
                    a = np.asarray(x, dtype=np.float64)  # a null component comes as NaN
                    if np.isfinite(a).all() and a.any():
                        v = a.astype(dtype).tobytes()
                out.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.binary())], ["vec_id", "label", "v"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string")).mapInArrow(run, "vec_id long, label string, v binary")


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def axes(classes: DataFrame, dtype: str, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Centre and leading principal axes of a sample of the most common dimension."""
    n = classes.count()
    if not n:
        return None
    share = min(1.0, sample / n)
    rows = classes.where(F.pmod(F.col("node"), F.lit(1 << 30)) <= F.lit(int(share * (1 << 30)))).select("v").collect()
    own = [np.frombuffer(r["v"], dtype).astype(float) for r in rows]
    if not own:
        return None
    sizes, counts = np.unique([len(v) for v in own], return_counts=True)
    x = unit(np.stack([v for v in own if len(v) == sizes[counts.argmax()]]))
    mean = x.mean(0)
    _, vecs = np.linalg.eigh((x - mean).T @ (x - mean))
    return mean, vecs[:, ::-1][:, :AXES]


def _project(x: np.ndarray, basis: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Coordinates on the leading axes; vectors of another dimension use their own first ones."""
    if basis is not None and len(basis[0]) == x.shape[1]:
        y = (x - basis[0]) @ basis[1]
    else:
        y = x[:, :AXES]
    return np.pad(y, ((0, 0), (0, AXES - y.shape[1]))) if y.shape[1] < AXES else y


def _close(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and the columns of a link matrix, the least number of their component: rows count first."""
    r, k = np.arange(mask.shape[0]), np.arange(mask.shape[1]) + mask.shape[0]
    big = mask.shape[0] + mask.shape[1]
    while True:
        k2 = np.minimum(k, np.where(mask, r[:, None], big).min(0))
        r2 = np.minimum(r, np.where(mask, k2[None], big).min(1))
        if (r2 == r).all() and (k2 == k).all():
            return r, k
        r, k = r2, k2


class Sequence:
    """Vectors in epsilon grid order: matrix, norms, leading coordinates, class sizes, and what is found."""

    def __init__(self, node: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray, epsilon: float) -> None:
        order = np.lexsort(np.floor(y / epsilon).T[::-1])
        self.node, self.size, self.x, self.y = node[order], size[order].astype(float), x[order], y[order]
        peak = np.abs(self.x).max(1, keepdims=True)
        self.scaled = self.x / peak
        self.norm = np.sqrt((self.scaled * self.scaled).sum(1))
        self.links = np.zeros(len(node))


def join(a: Sequence, b: Sequence, threshold: float, epsilon: float, link) -> None:
    """Counts links between a and b (or within a, if b is a), and calls link(node, node) for a spanning set of them."""

    def far(i: slice, j: slice) -> bool:
        gap = np.maximum(a.y[i].min(0) - b.y[j].max(0), b.y[j].min(0) - a.y[i].max(0))
        gap = np.maximum(gap, 0)
        return float((gap * gap).sum()) > (epsilon + SLACK) ** 2

    def recurse(i0: int, i1: int, j0: int, j1: int) -> None:
        if a is b and i0 > j0 or i1 <= i0 or j1 <= j0:
            return
        i, j = slice(i0, i1), slice(j0, j1)
        if far(i, j):
            return
        if max(i1 - i0, j1 - j0) > LEAF:
            im, jm = (i0 + i1) // 2, (j0 + j1) // 2
            for p, q, r, s in ((i0, im, j0, jm), (i0, im, jm, j1), (im, i1, j0, jm), (im, i1, jm, j1)):
                recurse(p, q, r, s)
            return
        mask = (a.scaled[i] @ b.scaled[j].T) / (a.norm[i][:, None] * b.norm[j][None]) >= threshold
        same = a is b and i0 == j0
        if same:
            np.fill_diagonal(mask, False)
        if not mask.any():
            return
        a.links[i] += mask @ b.size[j]
        if not same:
            b.links[j] += a.size[i] @ mask
        rows, cols = _close(mask)
        nodes = np.concatenate([a.node[i], b.node[j]])
        for k, root in enumerate(np.concatenate([rows, cols]).tolist()):
            if root != k:
                link(int(nodes[root]), int(nodes[k]))

    # Halving both sides at the same places keeps i0 <= j0 meaningful where a is b.
    recurse(0, len(a.node), 0, len(b.node))


def _units(dtype: str, basis, threshold: float, epsilon: float):
    """Rows sorted by (unit, side): the counts (kind 0: a, links) and forest links (kind 1: a, b) of each unit."""

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> pa.RecordBatch | None:
            if not rows:
                return None
            made = []
            for side in (0, 1):
                own = [r for r in rows if r[0] == side]
                if own:
                    x = np.stack([np.frombuffer(r[3], dtype) for r in own]).astype(float)
                    made.append(Sequence(np.array([r[1] for r in own], np.int64), np.array([r[2] for r in own]), x, _project(unit(x), basis), epsilon))
                else:
                    made.append(None)
            a, b = made
            sets, found = UnionFind(), []
            both = rows[0][4]  # whether the unit is a block with itself
            if a is not None and (both or b is not None):
                join(a, a if both else b, threshold, epsilon, lambda p, q: found.append((p, q)) if sets.join(p, q) else None)
            out = [(0, int(n), int(k)) for s in ((a,) if both else (a, b)) if s is not None for n, k in zip(s.node, s.links, strict=True) if k]
            out += [(1, p, q) for p, q in found]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["kind", "a", "b"]) if out else None

        for batch in batches:
            for u, *r in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if u != now:
                    if (out := flush()) is not None:
                        yield out
                    now, rows = u, []
                rows.append(r)
        if (out := flush()) is not None:
            yield out

    return run


def in_grid_order(classes: DataFrame, dtype: str, basis, epsilon: float, block: int = BLOCK) -> DataFrame:
    """node, v, size, label, dim, y (coordinates on the leading axes) and block: the number of the interval of the epsilon
    grid order, within a label and dimension, that the vector lies in. A block has `block` vectors at most."""

    @c.task
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.frombuffer(v, dtype).astype(float) for v in b.column(1).to_pylist()]
            y = np.stack([_project(unit(v[None]), basis)[0] for v in own]) if own else np.zeros((0, AXES))
            grid = np.floor(y / (epsilon + SLACK)).astype(np.int32)
            lists = [pa.array(list(x), pa.list_(kind)) for x, kind in ((y, pa.float64()), (grid, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), pa.array([len(v) for v in own], pa.int32()), *lists], ["node", "v", "size", "label", "dim", "y", "cells"])

    @c.task
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, now = TaskContext.get().partitionId() << 32, 0, None
        for b in batches:
            out = []
            for key in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if key != now or held == block:
                    number, held, now = number + 1, 0, key
                held += 1
                out.append(number)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(6)), pa.array(out, pa.int64())], ["node", "v", "size", "label", "dim", "y", "block"])

    fields = "node long, v binary, size long, label string, dim int, y array<double>"
    found = c.cut(classes.select("node", "v", "size", "label").mapInArrow(cells, fields + ", cells array<int>"), "cells")  # the sort samples it
    n = max(c.parts_for(found, 8), int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ("label", "dim", "cells", "node")
    return found.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(cut, fields + ", block long")


def near_blocks(placed: DataFrame, epsilon: float) -> DataFrame:
    """p, q: the pairs of blocks (p <= q) of one label and dimension whose boxes are within epsilon of each other.

    Only blocks that are within one cell of the first axis meet, by an equi-join.
    """
    sides = [f(F.element_at("y", k + 1)).alias(f"{name}{k}") for k in range(AXES) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    boxes = c.cut(placed.groupBy("label", "dim", "block").agg(*sides), "boxes")
    cell = lambda x: F.floor(F.col(x) / (epsilon + SLACK))
    a = boxes.withColumn("cell", F.explode(F.sequence(cell("lo0"), cell("hi0")))).withColumnsRenamed({"block": "p"})
    b = boxes.withColumn("cell", F.explode(F.sequence(cell("lo0") - 1, cell("hi0") + 1))).withColumnsRenamed({"block": "q"} | {f"{x}{k}": f"{x}{k}b" for k in range(AXES) for x in ("lo", "hi")})
    gap = lambda k: F.greatest(F.col(f"lo{k}") - F.col(f"hi{k}b"), F.col(f"lo{k}b") - F.col(f"hi{k}"), F.lit(0.0))
    far = sum((gap(k) * gap(k) for k in range(AXES)), F.lit(0.0))
    return a.join(b, ["label", "dim", "cell"]).where((F.col("p") <= F.col("q")) & (far <= (epsilon + SLACK) ** 2)).select("p", "q").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Vectors link when their labels are equal and their cosine in double precision is at least threshold. Without a
    label, or with a vector that is null, empty, zero or has a null or non-finite component, a row links with nothing;
    so do vectors of different dimensions. A null vec_id counts for no minimum. Other columns are ignored.
    """
    dtype = _floats(vectors.schema["embedding"].dataType)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    rows = c.cut(_prepare(vectors, dtype).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v"))), "vectors")
    classes = rows.where("v IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))
    classes = c.cut(classes, "classes")
    basis = axes(classes, dtype, sample)

    placed = c.cut(in_grid_order(classes, dtype, basis, epsilon, block), "blocks")
    pairs = c.cut(near_blocks(placed, epsilon), "pairs")
    send = lambda side, own, mine: placed.join(mine.withColumnRenamed(own, "block"), "block").select(F.xxhash64(*[F.col("block") if x == own else F.col(x) for x in ("p", "q")]).alias("unit"), F.lit(side).alias("side"), "node", "size", "v", F.col("block").eqNullSafe(F.col("q" if own == "p" else "p")).alias("both"))
    work = send(0, "p", pairs).unionByName(send(1, "q", pairs.where("p <> q")))
    n = max(c.parts_for(placed, 2), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = c.cut(work.repartition(n, "unit").sortWithinPartitions("unit", "side").mapInArrow(_units(dtype, basis, threshold, epsilon), "kind long, a long, b long"), "links")
    linked = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    joined = components(found.where("kind = 1").select("a", "b"))
    label = classes.select("node", "size", "least").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    per = label.join(least, "component").join(linked, "node", "left").select("node", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    out = rows.where("node IS NOT NULL").select("vec_id", "node").join(per, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(c.table(spark, sf_dir, "embeddings"))
