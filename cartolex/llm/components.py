"""Connected components of a table of links, without hot tasks and without the driver.

Each partition first reduces its links to a spanning forest. While many links are left, randomised contraction runs:
every node moves to the neighbour (or itself) that a hash of the round puts first, which shrinks the graph by a
constant factor a round whatever its shape. A remainder of bounded size is finished by one union-find task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Links that one task may finish (16 bytes each).
SMALL = 500_000


class UnionFind:
    """Over any integers; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.up.setdefault(min(a, b), min(a, b))
        return True


@c.task
def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets, a, b = UnionFind(), [], []
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if sets.join(x, y):
                a.append(x)
                b.append(y)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


@c.task
def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = UnionFind()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(x, y)
    nodes = np.fromiter(sets.up.keys(), np.int64, len(sets.up))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([sets.find(int(x)) for x in nodes], pa.int64())], ["node", "component"])


def components(links: DataFrame, small: int = SMALL) -> DataFrame:
    """node, component for every node of links (a long, b long): the smallest node that links reach.

    Loops and repeated links are harmless, null ends are dropped; nodes without a link to another have no row.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    links = c.cut(links.mapInArrow(_forest, "a long, b long"), "forest")
    moves: list[DataFrame] = []
    while (left := links.count()) > small:
        seed = F.lit(len(moves))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda x: F.struct(F.xxhash64(seed, x).alias("h"), F.col(x).alias("v"))
        to = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("node"), F.least(F.col("m"), order("a"))["v"].alias("to"))
        to = c.cut(to, "moves")
        new = links.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        new = c.cut(new.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct().mapInArrow(_forest, "a long, b long"), f"forest-{left}")
        c.drop(links)
        links = new
        moves.append(to)
    out = c.cut(links.repartition(1).mapInArrow(_labels, "node long, component long"), "labels")
    c.drop(links)
    for to in reversed(moves):
        below = out
        out = to.join(below.withColumnRenamed("node", "to"), "to", "left").select("node", F.coalesce("component", "to").alias("component"))
        out = c.cut(out, "labels")
        c.drop(below)
        c.drop(to)
    if moves:  # a label is then some node of the component, not the smallest
        least = out.groupBy("component").agg(F.min("node").alias("least"))
        out = out.join(least, "component").select("node", F.least("least", "component").alias("component"))
    return out
