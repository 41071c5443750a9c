"""Concept links, learning paths, splits by cluster, provenance marks."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from .. import scratch
from ..functions import columns as C
from ..graph import PropertyGraph, collapse_edges, endpoints_in
from . import fixpoint, kernels, relational

LINK_TYPES = ("PREREQUISITE", "ELABORATES", "EXAMPLE_OF", "TESTS")


def _links(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """concept, id: a Concept and a neighbour in either direction, over edges of every type."""
    concepts = scratch.shared(scratch.settle(nodes.where("type = 'Concept'").select(F.col("id").alias("concept")).distinct(), "concepts"))
    pair = lambda a, b: edges.select(F.col(a).alias("concept"), F.col(b).alias("id"))
    return pair("source", "target").unionByName(pair("target", "source")).join(concepts, "concept", "left_semi").distinct()


def mention_index(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """concept, nodes (sorted), n for each Concept with a neighbour."""
    return _links(nodes, edges).groupBy("concept").agg(F.array_sort(F.collect_set("id")).alias("nodes"), F.count(F.lit(1)).alias("n"))


def node_concepts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, concepts (sorted) for every node; empty without one."""
    own = _links(nodes, edges).groupBy("id").agg(F.array_sort(F.collect_set("concept")).alias("concepts"))
    return nodes.select("id").join(own, "id", "left").select("id", F.coalesce("concepts", F.array().cast("array<string>")).alias("concepts"))


def concept_usage(nodes: DataFrame, edges: DataFrame, concepts: DataFrame, locale: str = "ru") -> DataFrame:
    """concept_id, primary, n: a dictionary in alphabetical order with how often each is mentioned."""
    n = mention_index(nodes, edges).select(F.col("concept").alias("concept_id"), "n")
    out = concepts.select("concept_id", F.col("term.primary").alias("primary")).join(n, "concept_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.orderBy(F.collate("primary", locale), "concept_id")


def inter_cluster_links(nodes: DataFrame, edges: DataFrame, most: int = 3) -> DataFrame:
    """cluster_id, direction, place and the links of each cluster's most important sources in other clusters.

    TESTS links start at an Assessment; the other types touch a Concept. nodes: id, type, text, cluster_id,
    educational_importance.
    """
    end = lambda k: nodes.select(F.col("id").alias(k), F.coalesce(C.shortened(F.when(F.col("text") != "", F.col("text"))), F.col("id")).alias(k + "_text"), F.col("type").alias(k + "_type"), F.coalesce("educational_importance", F.lit(0.0)).alias(k + "_importance"), F.col("cluster_id").alias(k + "_cluster"))
    own = edges.where(F.col("type").isin(*LINK_TYPES)).join(end("source"), "source").join(end("target"), "target")
    rule = F.when(F.col("type") == "TESTS", F.col("source_type") == "Assessment").otherwise((F.col("source_type") == "Concept") | (F.col("target_type") == "Concept"))
    own = own.where(rule & (F.col("source_cluster") != F.col("target_cluster"))).withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    views = F.array(F.struct(F.col("target_cluster").alias("cluster_id"), F.lit("incoming").alias("direction"), F.col("source_cluster").alias("other_cluster")), F.struct(F.col("source_cluster").alias("cluster_id"), F.lit("outgoing").alias("direction"), F.col("target_cluster").alias("other_cluster")))
    both = own.withColumn("v", F.explode(views))
    place = F.row_number().over(W.partitionBy("v.cluster_id", "v.direction").orderBy(F.desc("source_importance"), "_ord"))
    shown = ["source", "source_text", "source_type", "source_importance", "target", "target_text", "target_type", "target_importance", "type", "weight", *(["conditions"] if "conditions" in edges.columns else [])]
    return both.withColumn("place", place).where(F.col("place") <= most).select("v.cluster_id", "v.direction", "place", *shown, "v.other_cluster")


def cluster_concepts(nodes: DataFrame, concepts: DataFrame) -> DataFrame:
    """cluster_id, concept_id, primary, own_cluster: the dictionary's concepts that a cluster's nodes name, with the cluster
    of the Concept node itself."""
    named = nodes.select("cluster_id", F.explode("concepts").alias("concept_id")).distinct()
    own = nodes.where("type = 'Concept'").select(F.col("id").alias("concept_id"), F.col("cluster_id").alias("own_cluster"))
    return named.join(concepts.select("concept_id", F.col("term.primary").alias("primary")), "concept_id").join(own, "concept_id", "left").select("cluster_id", "concept_id", "primary", "own_cluster")


def split(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes and inner edges of each cluster of two nodes or more, with cluster_name (padded with zeros) for partitioned output."""
    sizes = nodes.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cluster_id")
    most = nodes.agg(F.max("cluster_id").alias("most"))
    named = nodes.join(sizes, "cluster_id", "left_semi").crossJoin(F.broadcast(most)).withColumn("cluster_name", relational.padded(F.col("cluster_id"), F.col("most"))).drop("most")
    k = lambda e: named.select(F.col("id").alias(e), F.col("cluster_id").alias(e + "_k"), F.col("cluster_name").alias(e + "_name"))
    inner = edges.join(k("source"), "source").join(k("target"), "target").where("source_k = target_k")
    return named, inner.withColumn("cluster_id", F.col("source_k")).withColumn("cluster_name", F.col("source_name")).drop("source_k", "target_k", "source_name", "target_name")


def write_split(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    n, e = split(nodes, edges)
    n.write.mode("overwrite").partitionBy("cluster_name").json(f"{path}/nodes")
    e.write.mode("overwrite").partitionBy("cluster_name").json(f"{path}/edges")


def fix(nodes: DataFrame, edges: DataFrame, concepts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph with provenance marks, and Concept texts from the dictionary (those it lacks stay)."""
    d = concepts.select(F.col("concept_id").alias("id"), C.term_text(F.col("term.primary"), F.col("term.aliases")).alias("__text"))
    out = nodes.withColumn("definition", C.marked_definition(F.col("type"), F.col("definition"))).join(d, "id", "left")
    out = out.withColumn("text", F.when((F.col("type") == "Concept") & F.col("__text").isNotNull(), F.col("__text")).otherwise(F.col("text"))).drop("__text")
    return out, edges.withColumn("conditions", C.marked_conditions(F.col("conditions")))


def fix_stats(nodes: DataFrame, edges: DataFrame, new_nodes: DataFrame, new_edges: DataFrame) -> DataFrame:
    """chunks_marked, assessments_marked, concepts_updated, edges_marked; a dry run is to look at these and not write."""
    a = nodes.select("id", F.col("type").alias("t"), F.col("definition").alias("d0"), F.col("text").alias("t0")).join(new_nodes.select("id", "definition", "text"), "id")
    changed = ~F.col("d0").eqNullSafe(F.col("definition"))
    left = a.agg(F.count_if((F.col("t") == "Chunk") & changed).alias("chunks_marked"), F.count_if((F.col("t") == "Assessment") & changed).alias("assessments_marked"), F.count_if((F.col("t") == "Concept") & ~F.col("t0").eqNullSafe(F.col("text"))).alias("concepts_updated"))
    right = edges.select("_ord", F.col("conditions").alias("c0")).join(new_edges.select("_ord", "conditions"), "_ord").agg(F.count_if(~F.col("c0").eqNullSafe(F.col("conditions"))).alias("edges_marked"))
    return left.crossJoin(right)  # one row each


def showcase(nodes: DataFrame, most: int) -> DataFrame:
    """seq, id: the node of the highest PageRank in each cluster, by prerequisite depth; of more than `most` clusters the
    largest (ties by the cluster's first node)."""
    k = F.coalesce("cluster_id", F.lit(0))
    own = W.partitionBy("__k")
    best = nodes.withColumn("__k", k).withColumn("__size", F.count(F.lit(1)).over(own)).withColumn("__first", F.min("_ord").over(own))
    best = best.withColumn("__r", F.row_number().over(own.orderBy(F.desc(F.coalesce("pagerank", F.lit(0.0))), "_ord"))).where("__r = 1")
    chosen = best.orderBy(F.desc("__size"), "__first").limit(most)
    n = nodes.select(k.alias("k")).distinct().count()
    tie = ["__first"] if n <= most else [F.desc("__size"), "__first"]
    return chosen.select(F.row_number().over(W.orderBy(F.coalesce("prerequisite_depth", F.lit(0)), *tie)).alias("seq"), "id")


class _Plan:
    """Greedy tours over a graph of bounded size (see demo_path)."""

    def __init__(self, nodes: list[dict], edges: list[tuple[str, str, str]]) -> None:
        self.nodes = {n["id"]: n for n in nodes}
        self.edges = edges

    def value(self, v: str, metric: str) -> float:
        x = self.nodes[v].get(metric)
        return 0.0 if x is None or x != x else x

    def ranked(self, metric: str, among=None) -> list[str]:
        return sorted(self.nodes if among is None else among, key=lambda v: -self.value(v, metric))

    def adjacency(self, types: tuple[str, ...] | None, reverse: bool = False) -> dict[str, list[str]]:
        out: dict[str, list[str]] = defaultdict(list)
        for s, t, kind in self.edges:
            if types is None or kind in types:
                out[t if reverse else s].append(s if reverse else t)
        return out

    def fill(self, path: list[str], upto: int, metric: str) -> None:
        have = set(path)
        path += [v for v in self.ranked(metric) if v not in have][: max(0, upto - len(path))]

    def finish(self, path: list[str], most: int, fills: tuple[str, ...], last: str) -> list[str]:
        target = min(most // 2, 50)
        for k, metric in enumerate(fills):
            if len(path) < (min(15, most) if k == 0 else target):
                self.fill(path, target, metric)
        self.fill(path, most, last)
        return sorted(path, key=lambda v: self.value(v, "prerequisite_depth"))[:most]

    def optimal(self, most: int) -> list[str]:
        least = min(self.value(v, "prerequisite_depth") for v in self.nodes)
        start = self.ranked("educational_importance", [v for v in self.nodes if self.value(v, "prerequisite_depth") == least])[0]
        near, wide = self.adjacency(S.EDUCATIONAL), self.adjacency(None)
        path, seen = [start], {start}
        for goal in self.ranked("educational_importance")[: int(most * 1.5)]:
            if goal in seen or len(path) >= most:
                continue
            for out, longest in ((near, None), (wide, 5)):
                parent = kernels.hops(path[-1], out, goal)
                if goal in parent:
                    steps = kernels.walk(parent, goal)
                    if longest is None or len(steps) <= longest:
                        for v in steps[1:]:
                            if v not in seen and len(path) < most:
                                path.append(v)
                                seen.add(v)
                    break
        return self.finish(path, most, ("pagerank", "bridge_score", "betweenness_centrality"), "educational_importance")

    def critical(self, most: int) -> list[str]:
        top = max(self.value(v, "learning_effort") for v in self.nodes)
        hard = self.nodes if top == 0 else [v for v in self.nodes if self.value(v, "learning_effort") >= 0.9 * top]
        start = self.ranked("educational_importance", hard)[0]
        back = self.adjacency(("PREREQUISITE", "ELABORATES", "EXAMPLE_OF"), reverse=True)
        seen, queue, k = {start}, [start], 0
        found: list[str] = []
        while k < len(queue) and len(found) < 2 * most:
            for v in back.get(queue[k], ()):
                if v not in seen:
                    seen.add(v)
                    found.append(v)
                    queue.append(v)
            k += 1
        found.sort(key=lambda v: (self.value(v, "prerequisite_depth"), -self.value(v, "educational_importance")))
        path = [start, *found][:most]
        return self.finish(path, most, ("betweenness_centrality", "pagerank", "educational_importance"), "learning_effort")


def demo_path(graph: PropertyGraph, strategy: int = 1, most: int = 15) -> DataFrame:
    """seq, id of a tour: 1 optimal, 2 showcase, 3 critical (others: optimal).

    Showcase is windows alone. The other two are greedy and order-dependent; they run in one task over the ids and
    metrics of the nodes and the ends of the collapsed edges (some 300 bytes each). A tour has `most` nodes at most.
    """
    nodes = graph.nodes
    if strategy == 2 and nodes.select(F.coalesce("cluster_id", F.lit(0))).distinct().count() > 1:
        return showcase(nodes, most)
    edges = collapse_edges(graph.edges)
    metrics = ["prerequisite_depth", "educational_importance", "learning_effort", "pagerank", "bridge_score", "betweenness_centrality"]
    have = [m for m in metrics if m in nodes.columns]
    n = nodes.select("_ord", F.col("id").alias("source"), F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("type"), *[F.col(m).cast("double").alias(m) for m in have])
    rows = n.unionByName(edges.select("_ord", "source", "target", "type"), allowMissingColumns=True).withColumn("one", F.lit(1))

    def plan(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_ord", kind="stable")
        own, e = g[g["target"].isna()], g[g["target"].notna()]
        p = _Plan(own.rename(columns={"source": "id"})[["id", *have]].to_dict("records"), list(zip(e["source"], e["target"], e["type"], strict=True)))
        path = (p.critical if strategy == 3 else p.optimal)(most) if p.nodes else []
        return pd.DataFrame({"seq": range(1, len(path) + 1), "id": path})

    return rows.groupBy("one").applyInPandas(plan, "seq int, id string")


def shortest_path(edges: DataFrame, start: str, goal: str) -> DataFrame:
    """seq, id along a path of the fewest edges; of equal parents the smallest id. No rows if there is none."""
    spark = edges.sparkSession
    seen = scratch.settle(fixpoint.breadth_first(edges, spark.createDataFrame([(start,)], "id string")), "bfs")
    if fixpoint.is_small(seen):

        def follow(g: pd.DataFrame) -> pd.DataFrame:
            parent = {v: p if isinstance(p, str) else None for v, p in zip(g["id"], g["parent"], strict=True)}
            path = kernels.walk(parent, goal) if goal in parent else []
            return pd.DataFrame({"seq": list(range(len(path))), "id": pd.Series([str(v) for v in path], dtype=object)})

        return seen.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(follow, "seq int, id string")
    path, at = [], goal
    while at is not None:  # one lookup for each step of the path
        row = seen.where(F.col("id") == at).select("parent").first()
        if row is None:
            return spark.createDataFrame([], "seq int, id string")
        path.append(at)
        at = row["parent"]
    return spark.createDataFrame(list(enumerate(reversed(path))), "seq int, id string")


def ladder_path(edges: DataFrame, start: str, goal: str, tiers: tuple[tuple[str, ...], ...] = (S.STRONG, S.MEDIUM, S.WEAK)) -> DataFrame:
    """The shortest path over the first tiers of edge types that have one."""
    types: tuple[str, ...] = ()
    for more in tiers:
        types += more
        path = shortest_path(edges.where(F.col("type").isin(*types)), start, goal)
        if not path.isEmpty():
            return path
    return path


def _difficulty() -> Column:
    """A node's difficulty; none, or 0, is the usual one."""
    return F.when(F.coalesce("difficulty", F.lit(0)) == 0, F.lit(S.DIFFICULTY)).otherwise(F.col("difficulty"))


def path_summary(path: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: steps of a path (seq from 0, id) and the sum of its nodes' difficulties but for the start; nulls if there
    is no path. A node that is unknown counts for nothing."""
    own = path.where("seq > 0").join(nodes.select("id", _difficulty().alias("__d")), "id", "left").agg(F.coalesce(F.sum("__d"), F.lit(0)).cast("long").alias("difficulty"))
    steps = path.agg(F.max("seq").cast("long").alias("steps"))
    return steps.crossJoin(own).select("steps", F.when(F.col("steps").isNotNull(), F.col("difficulty")).alias("difficulty"))  # one row each


def easiest_path(nodes: DataFrame, edges: DataFrame, start: str, goal: str, alpha: float = 0.0, beta: float = 1.0, sigma: float = 0.5) -> DataFrame:
    """seq, id, cost so far along a path of the least sum of path_costs(); among several the one of the fewest edges, and
    of equal parents the smallest id. No rows if there is none.

    An edge lies on an easiest path if its cost is just what its ends' least costs differ by; the path is the shortest
    over such edges.
    """
    costs = path_costs(nodes, edges, alpha, beta, sigma).select("source", "target", "cost")
    least = scratch.settle(least_costs(costs, start), "least")
    of = lambda end: least.select(F.col("id").alias(end), F.col("cost").alias("__" + end))
    tight = costs.join(of("source"), "source").join(of("target"), "target").where("__source + cost = __target").select("source", "target")
    return shortest_path(tight, start, goal).join(least, "id").select("seq", "id", "cost")


def path_costs(nodes: DataFrame, edges: DataFrame, alpha: float = 0.0, beta: float = 1.0, sigma: float = 0.5) -> DataFrame:
    """edges with cost = alpha + beta * difficulty of the target + sigma * (1 - weight); a weight of 0 or none counts as 1."""
    d = nodes.select(F.col("id").alias("target"), _difficulty().alias("__d"))
    w = F.when(F.coalesce("weight", F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("weight"))
    return edges.join(d, "target").withColumn("cost", alpha + beta * F.col("__d") + sigma * (1 - w)).drop("__d")


def least_costs(costs: DataFrame, start: str, small: bool | None = None) -> DataFrame:
    """id, cost: the least sum of costs from start to each node that it reaches (Bellman and Ford's relaxation).

    Large graphs take rounds until no cost falls; costs that still fall after a round for each node go round a cycle of
    negative cost and have no least sum.
    """
    spark = costs.sparkSession
    if fixpoint.is_small(costs) if small is None else small:

        def search(g: pd.DataFrame) -> pd.DataFrame:
            out = defaultdict(list)
            for s, t, c in zip(g["source"], g["target"], g["cost"], strict=True):
                out[s].append((t, c))
            found = kernels.distances(start, out)
            return pd.DataFrame({"id": list(found), "cost": list(found.values())})

        seed = spark.createDataFrame([(start, start, 0.0)], "source string, target string, cost double")
        return costs.select("source", "target", "cost").unionByName(seed).withColumn("one", F.lit(1)).groupBy("one").applyInPandas(search, "id string, cost double")
    best = scratch.settle(spark.createDataFrame([(start, 0.0)], "id string, cost double"), "costs")
    front = best
    rounds = costs.select("target").distinct().count() + 1
    for _ in range(rounds):
        step = front.select(F.col("id").alias("source"), F.col("cost").alias("before")).join(costs.select("source", "target", "cost"), "source").groupBy(F.col("target").alias("id")).agg(F.min(F.col("before") + F.col("cost")).alias("new"))
        better = scratch.settle(step.join(best, "id", "left").where("cost IS NULL OR new < cost").select("id", F.col("new").alias("cost")), "front")
        if better.isEmpty():
            break
        best = scratch.settle(best.join(better.select("id"), "id", "left_anti").unionByName(better), "costs")
        front = better
    else:
        raise ValueError("a cycle of negative cost")
    return best


def ancestors(edges: DataFrame, start: str, types: tuple[str, ...] = ("PREREQUISITE", "ELABORATES", "EXAMPLE_OF"), most: int = 30) -> DataFrame:
    """id, hops of what leads to a node over the types, within so many steps."""
    own = edges.where(F.col("type").isin(*types)).select(F.col("target").alias("source"), F.col("source").alias("target"))
    return fixpoint.breadth_first(own, edges.sparkSession.createDataFrame([(start,)], "id string"), most).where("hops > 0").select("id", "hops")


def large_graph(graph: PropertyGraph, most: int = 1000) -> PropertyGraph:
    n, e = relational.top_nodes(graph.nodes, graph.edges, most)
    return PropertyGraph(n, endpoints_in(e, n))
