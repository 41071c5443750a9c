"""Iterative graph algorithms: components, reachability, longest paths, shortest paths.

Graphs of up to SMALL edges are gathered in one task, where a kernel takes no rounds; larger ones run as DataFrame loops.
"""

from __future__ import annotations

import itertools
from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import scratch


#: Rows of each table up to which one task does the work.
SMALL = 100_000


def is_small(*tables: DataFrame) -> bool:
    return all(t.limit(SMALL + 1).count() <= SMALL for t in tables)


def _least_roots(g: pd.DataFrame) -> pd.DataFrame:
    up: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for a, b in zip(g["a"], g["b"], strict=True):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return pd.DataFrame({"id": list(up), "root": [find(x) for x in list(up)]})


def connected_components(nodes: DataFrame, edges: DataFrame, small: bool | None = None) -> DataFrame:
    """id, root: the smallest id that edges reach in either direction.

    Each round hooks every root to the least root among its neighbours' and then halves all chains, so that the number
    of rounds follows the logarithm of the longest path rather than its length.
    """
    if is_small(nodes, edges) if small is None else small:
        rows = nodes.select(F.col("id").alias("a"), F.col("id").alias("b")).unionByName(edges.select(F.col("source").alias("a"), F.col("target").alias("b")).where("a IS NOT NULL AND b IS NOT NULL"))
        found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_least_roots, "id string, root string")
        return found.join(nodes.select("id").distinct(), "id", "left_semi")
    named = scratch.in_order(nodes.select("id").distinct(), "id").select("id", F.col("__n").alias("n"))
    labels = named.select("n", F.col("n").alias("root"))
    # Numbers in the order of the ids stand for them, and only links between different roots go on.
    links = edges.where("source <> target").select("source", "target")
    for end, to in (("source", "a"), ("target", "b")):
        links = links.join(named.select(F.col("id").alias(end), F.col("n").alias(to)), end).drop(end)
    links = scratch.settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        # Of a link's two roots only the greater can hook on.
        least = scratch.settle(links.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")), "hooks")
        if least.isEmpty():
            break
        # A hook's target may have hooked on as well: follow the chain until it ends.
        while True:
            onward = least.select(F.col("root").alias("to"), F.col("to").alias("further"))
            jumped = scratch.settle(least.join(onward, "to", "left").select("root", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "hooks")
            scratch.drop(least)
            least, moved = jumped.select("root", "to"), not jumped.where("moved").isEmpty()
            least._cartolex_path = jumped._cartolex_path
            if not moved:
                break
        new = scratch.settle(labels.join(least, "root", "left").select("n", F.coalesce("to", "root").alias("root")), "labels")
        scratch.drop(labels)
        labels, old = new, links
        for end in ("a", "b"):
            links = links.join(least.select(F.col("root").alias(end), F.col("to").alias("__to")), end, "left").withColumn(end, F.coalesce("__to", end)).drop("__to")
        links = scratch.settle(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        scratch.drop(old, least)
    out = labels.join(named, "n").select("id", "root").join(named.select(F.col("n").alias("root"), F.col("id").alias("name")), "root").select("id", F.col("name").alias("root"))
    return scratch.settle(out, "roots")


def component_ids(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, component_id: weakly connected components, numbered by the first node in order."""
    roots = connected_components(nodes, edges)
    first = roots.join(nodes.select("id", "_ord"), "id").groupBy("root").agg(F.min("_ord").alias("first"))
    numbered = first.withColumn("component_id", (F.dense_rank().over(W.orderBy("first")) - 1).cast("int"))  # one row per component
    return roots.join(numbered, "root").select("id", "component_id")


def _levels(most: int | None):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list[str]] = defaultdict(list)
        first = g["target"].isna()
        for s, t in zip(g["source"][~first], g["target"][~first], strict=True):
            out[s].append(t)
        hops = dict.fromkeys(g["source"][first], 0)
        parent: dict[str, str | None] = dict.fromkeys(hops)
        queue = deque(hops)
        while queue:
            v = queue.popleft()
            for w in out[v] if most is None or hops[v] < most else ():
                if w not in hops:
                    hops[w], parent[w] = hops[v] + 1, v
                    queue.append(w)
                elif hops[w] == hops[v] + 1:
                    parent[w] = min(parent[w], v)
        return pd.DataFrame({"id": list(hops), "hops": list(hops.values()), "parent": [parent[v] for v in hops]})

    return run


def breadth_first(edges: DataFrame, start: DataFrame, most: int | None = None, small: bool | None = None) -> DataFrame:
    """id, hops, parent: the fewest edges from start (id) to each node it reaches, or reaches within `most` edges; of equal
    parents the smallest id."""
    if is_small(edges, start) if small is None else small:
        rows = edges.select("source", "target").where("target IS NOT NULL").unionByName(start.select(F.col("id").alias("source"), F.lit(None).cast("string").alias("target")))
        return rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_levels(most), "id string, hops int, parent string")
    seen = scratch.settle(start.select("id", F.lit(0).alias("hops"), F.lit(None).cast("string").alias("parent")).distinct(), "seen")
    front = seen
    for hop in itertools.count(1) if most is None else range(1, most + 1):
        step = front.select(F.col("id").alias("source")).join(edges.select("source", "target"), "source").groupBy(F.col("target").alias("id")).agg(F.min("source").alias("parent"))
        front = scratch.settle(step.join(seen.select("id"), "id", "left_anti").select("id", F.lit(hop).alias("hops"), "parent"), "front")
        if front.isEmpty():
            break
        seen = scratch.settle(seen.unionByName(front), "seen")
    return seen


def longest_levels(nodes: DataFrame, edges: DataFrame, own: str) -> DataFrame:
    """id, depth, total on an acyclic graph: the most edges on a path to the node, and its own value plus the largest
    total of a predecessor. Level by level: a node is final once all its predecessors are (Kahn's order)."""
    left = edges.where("source <> target").select("source", "target").distinct()
    done = None
    todo = nodes.select("id", F.col(own).cast("double").alias("own"))
    state = scratch.settle(todo.select("id", "own", F.lit(0).alias("depth"), F.lit(0.0).alias("best")), "levels")
    left = scratch.settle(left, "left")
    while True:
        waiting = left.select(F.col("target").alias("id")).distinct()
        ready = scratch.settle(state.join(waiting, "id", "left_anti").select("id", "depth", (F.col("own") + F.col("best")).alias("total"), "own", "best"), "ready")
        if ready.isEmpty():
            break
        done = ready if done is None else scratch.settle(done.unionByName(ready), "done")
        on = left.join(ready.select(F.col("id").alias("source"), "depth", "total"), "source").groupBy(F.col("target").alias("id")).agg((F.max("depth") + 1).alias("d"), F.max("total").alias("t"))
        rest = state.join(ready.select("id"), "id", "left_anti")
        state = scratch.settle(rest.join(on, "id", "left").select("id", "own", F.greatest("depth", F.coalesce("d", F.lit(0))).alias("depth"), F.greatest("best", F.coalesce("t", F.lit(0.0))).alias("best")), "levels")
        left = scratch.settle(left.join(ready.select(F.col("id").alias("source")), "source", "left_anti"), "left")
    if done is None:
        return state.select("id", "depth", "own").withColumnRenamed("own", "total")
    return done.select("id", "depth", "total")


def strong_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, scc: a representative of the node's strongly connected component.

    Nodes without a predecessor or a successor among the rest are their own components and are trimmed away first. Then
    the least id that reaches a node colours it, and within a colour what reaches back to the colour's root is one
    component; both are propagated until nothing changes, and the rest goes round again.
    """
    rest = scratch.settle(nodes.select("id").distinct(), "rest")
    links = scratch.settle(edges.where("source <> target").select("source", "target").distinct(), "links")
    found = nodes.select("id", F.col("id").alias("scc")).limit(0)
    while not links.isEmpty():
        inner = rest.join(links.select(F.col("source").alias("id")), "id", "left_semi").join(links.select(F.col("target").alias("id")), "id", "left_semi")
        inner = scratch.settle(inner, "inner")
        gone = rest.join(inner, "id", "left_anti")
        if not gone.isEmpty():
            found = scratch.settle(found.unionByName(gone.select("id", F.col("id").alias("scc"))), "found")
            rest = inner
            links = scratch.settle(_inside(links, rest), "links")
            continue
        colour = _spread(rest.select("id", F.col("id").alias("root")), links)
        same = links.join(colour.withColumnsRenamed({"id": "source", "root": "rs"}), "source").join(colour.withColumnsRenamed({"id": "target", "root": "rt"}), "target").where("rs = rt")
        back = scratch.settle(same.select(F.col("target").alias("source"), F.col("source").alias("target")), "back")
        seen = breadth_first(back, colour.where("id = root").select("id"))
        own = colour.join(seen.select("id"), "id", "left_semi").select("id", F.col("root").alias("scc"))
        found = scratch.settle(found.unionByName(own), "found")
        rest = scratch.settle(rest.join(own.select("id"), "id", "left_anti"), "rest")
        links = scratch.settle(_inside(links, rest), "links")
    return found.unionByName(rest.select("id", F.col("id").alias("scc")))


def _inside(links: DataFrame, ids: DataFrame) -> DataFrame:
    return links.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi").select("source", "target")


def _spread(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The least root among those that reach each node."""
    labels = scratch.settle(labels, "colours")
    while True:
        best = links.join(labels.withColumnRenamed("id", "source"), "source").groupBy(F.col("target").alias("id")).agg(F.min("root").alias("new"))
        new = scratch.settle(labels.join(best, "id", "left").select("id", F.least("root", F.coalesce("new", "root")).alias("root"), (F.col("new") < F.col("root")).alias("moved")), "colours")
        labels = new.select("id", "root")
        if new.where("moved").isEmpty():
            return labels
