"""Node metrics: degrees, PageRank, betweenness and closeness, prerequisites, communities, bridges."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from .. import scratch
from ..functions import columns as C
from ..graph import PropertyGraph, collapse_edges, endpoints_in
from . import fixpoint, kernels


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, degree_in, degree_out, degree_centrality; a self-loop counts on both sides. edges: collapsed."""
    ends = edges.select(F.col("source").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(edges.select(F.col("target").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    sums = ends.groupBy("id").agg(F.sum("i").alias("degree_in"), F.sum("o").alias("degree_out"))
    n = nodes.agg(F.count(F.lit(1)).alias("n"))
    out = nodes.select("id").join(sums, "id", "left").crossJoin(F.broadcast(n))  # one row on the right
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    share = F.when(F.col("n") > 1, (zero("degree_in") + zero("degree_out")) / (F.col("n") - 1)).otherwise(F.lit(1.0))
    return out.select("id", zero("degree_in").alias("degree_in"), zero("degree_out").alias("degree_out"), share.alias("degree_centrality"))


def _gathered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One table of a small graph's nodes (target null) and edges, under one key."""
    n = nodes.select(F.col("_ord"), F.col("id").alias("source"), F.lit(None).cast("string").alias("target"), F.col("difficulty").cast("double").alias("weight")) if "difficulty" in nodes.columns else nodes.select("_ord", F.col("id").alias("source"), F.lit(None).cast("string").alias("target"), F.lit(None).cast("double").alias("weight"))
    return n.unionByName(edges.select("_ord", "source", "target", "weight")).withColumn("one", F.lit(1))


def _split(g: pd.DataFrame) -> tuple[list[str], list[tuple[str, str, float]], dict[str, float]]:
    g = g.sort_values("_ord", kind="stable")
    n, e = g[g["target"].isna()], g[g["target"].notna()]
    difficulty = {k: S.DIFFICULTY if pd.isna(v) else float(v) for k, v in zip(n["source"], n["weight"], strict=True)}
    known = set(difficulty)
    return list(n["source"]), [(s, t, w) for s, t, w in zip(e["source"], e["target"], e["weight"], strict=True) if s in known and t in known], difficulty


def _ranks_by_rounds(nodes: DataFrame, edges: DataFrame, damping: float, rounds: int, tol: float) -> tuple[DataFrame, bool]:
    """id, x as kernels.pagerank() has them, by joins; and whether they settled."""
    n = nodes.count()
    known = endpoints_in(edges, nodes)
    total = known.groupBy("source").agg(F.sum("weight").alias("total"))
    share = scratch.settle(known.join(total, "source").where("total > 0").select("source", "target", (F.col("weight") / F.col("total")).alias("share")), "shares")
    senders = scratch.settle(share.select(F.col("source").alias("id")).distinct(), "senders")
    x, settled = scratch.settle(nodes.select("id", F.lit(1.0 / max(n, 1)).alias("x"), F.lit(0.0).alias("was")), "rank"), n == 0
    for _ in range(rounds if n else 0):
        loose = x.join(senders, "id", "left_anti").agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0] / n
        got = share.join(x.withColumnRenamed("id", "source"), "source").groupBy(F.col("target").alias("id")).agg(F.sum(F.col("share") * F.col("x")).alias("got"))
        new = x.select("id", F.col("x").alias("was")).join(got, "id", "left").select("id", (damping * (F.coalesce("got", F.lit(0.0)) + loose) + (1 - damping) / n).alias("x"), "was")
        new = scratch.settle(new, "rank")
        scratch.drop(x)
        x = new
        if x.agg(F.sum(F.abs(F.col("x") - F.col("was")))).first()[0] < n * tol:
            settled = True
            break
    scratch.drop(share, senders)
    return x.select("id", "x"), settled


def pagerank(nodes: DataFrame, edges: DataFrame, name: str = "pagerank", damping: float = 0.85, rounds: int = 100, tol: float = 1e-6, small: bool | None = None) -> DataFrame:
    """id and the rank. Edges with an end that is no node count for nothing. If the ranks don't settle in time, twice as
    many rounds with a tolerance of 1e-3 are taken. edges: collapsed. Both strategies follow the same rules."""
    if fixpoint.is_small(nodes, edges) if small is None else small:

        def kernel(g: pd.DataFrame) -> pd.DataFrame:
            ids, links, _ = _split(g)
            ranks, settled = kernels.pagerank(ids, links, damping, rounds, tol)
            if not settled:
                ranks, _ = kernels.pagerank(ids, links, damping, 2 * rounds, 1e-3)
            return pd.DataFrame({"id": list(ranks), name: list(ranks.values())})

        return _gathered(nodes, edges).groupBy("one").applyInPandas(kernel, f"id string, `{name}` double")
    ranks, settled = _ranks_by_rounds(nodes, edges, damping, rounds, tol)
    if not settled:
        ranks, _ = _ranks_by_rounds(nodes, edges, damping, 2 * rounds, 1e-3)
    return ranks.withColumnRenamed("x", name)


def pagerank_rounds(nodes: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """id, pagerank after exactly so many rounds (no test of convergence), by the strategy for large graphs."""
    return _ranks_by_rounds(nodes, edges, 0.85, rounds, -1.0)[0].withColumnRenamed("x", "pagerank")


def educational(edges: DataFrame, types: tuple[str, ...] = S.EDUCATIONAL, fold_case: bool = True) -> DataFrame:
    kind = F.upper("type") if fold_case else F.col("type")
    return edges.where(kind.isin(*types))


def educational_importance(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return pagerank(nodes, educational(edges), "educational_importance")


#: Edges up to which each task holds the adjacency (some 150 bytes each); beyond it paths are found by joins.
BROADCAST_EDGES = 500_000
#: Rows of (source, node) that a batch of sources has at most, where paths are found by joins.
BATCH_ROWS = 200_000_000


def path_metrics(nodes: DataFrame, edges: DataFrame, tasks: int = 8, small: bool | None = None) -> DataFrame:
    """id, betweenness_centrality, out-closeness by weighted shortest paths of length 1 / weight. edges: collapsed.

    Sources are dealt to tasks, each of which holds the adjacency (a broadcast whose size is checked: BROADCAST_EDGES at
    most) and searches from its own; their dependencies are summed by node. The paths of larger graphs are found by
    joins, some sources at a time. Either way the result is exact, and takes nodes times edges.
    """
    length = edges.select("source", "target", C.inverse_weight(F.col("weight")).alias("length"), "_ord")
    if not (edges.limit(BROADCAST_EDGES + 1).count() <= BROADCAST_EDGES if small is None else small):
        return _paths_by_rounds(nodes, length)
    spark = nodes.sparkSession
    rows = length.orderBy("_ord").toPandas()
    adjacency: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for s, t, far in zip(rows["source"], rows["target"], rows["length"], strict=True):
        if far != float("inf"):
            adjacency[s].append((t, far))
    # Edges without a finite length reach their target at infinity, which makes a source's closeness 0.
    endless = set(rows.loc[rows["length"] == float("inf"), "source"])
    shared = spark.sparkContext.broadcast((dict(adjacency), endless))
    n = nodes.count()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, bad = shared.value
        for b in batches:
            dependency: dict[str, float] = defaultdict(float)
            near = {}
            for source in b["id"]:
                distance, share = kernels.from_source(source, out)
                near[source] = 0.0 if bad & set(distance) else kernels.closeness(distance, n)
                for v, x in share.items():
                    dependency[v] += x
            ids = sorted(set(near) | set(dependency))
            yield pd.DataFrame({"id": ids, "dependency": [dependency.get(v, 0.0) for v in ids], "near": [near.get(v, 0.0) for v in ids]})

    found = nodes.select("id").repartition(tasks, "id").mapInPandas(search, "id string, dependency double, near double")
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return found.groupBy("id").agg((F.sum("dependency") * scale).alias("betweenness_centrality"), F.sum("near").alias("out-closeness")).join(nodes.select("id"), "id")


def _paths_by_rounds(nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """path_metrics() by joins: distances by rounds of relaxation, then the number of shortest paths outwards and
    dependencies inwards along the edges that lie on them, as many rounds as those have edges in a row."""
    n = nodes.count()
    links = scratch.settle(lengths.where(F.col("length") < float("inf")).select(F.col("source").alias("u"), F.col("target").alias("v"), "length"), "links")
    endless = scratch.settle(lengths.where(F.col("length") == float("inf")).select(F.col("source").alias("v")).distinct(), "endless")
    batches = max(1, -(-n * n // BATCH_ROWS))
    done: list[DataFrame] = []
    for k in range(batches):
        own = nodes.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == k).select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0.0).alias("d"))
        far = front = scratch.settle(own, "far")
        while not front.isEmpty():
            step = front.withColumnRenamed("v", "u").join(links, "u").groupBy("s", "v").agg(F.min(F.col("d") + F.col("length")).alias("new"))
            front = scratch.settle(step.join(far, ["s", "v"], "left").where("d IS NULL OR new < d").select("s", "v", F.col("new").alias("d")), "front")
            far = scratch.settle(far.join(front.select("s", "v"), ["s", "v"], "left_anti").unionByName(front), "far")
        tails = far.withColumnsRenamed({"v": "u", "d": "du"})
        tight = scratch.settle(tails.join(links, "u").join(far, ["s", "v"]).where("du + length = d AND v <> s").select("s", "u", "v"), "tight")
        first = far.where("v = s").select("s", "v", F.lit(1.0).alias("paths"))
        paths, rounds = scratch.settle(first, "paths"), 0
        while True:
            new = tight.join(paths.withColumnRenamed("v", "u"), ["s", "u"]).groupBy("s", "v").agg(F.sum("paths").alias("paths"))
            new = scratch.settle(new.unionByName(first), "paths")
            same = new.join(paths.withColumnRenamed("paths", "was"), ["s", "v"], "left").where("was IS NULL OR was <> paths").isEmpty()
            paths = new
            if same:
                break
            rounds += 1
        part = tight.join(paths.withColumnsRenamed({"v": "u", "paths": "pu"}), ["s", "u"]).join(paths, ["s", "v"]).select("s", "u", "v", (F.col("pu") / F.col("paths")).alias("part"))
        part = scratch.settle(part, "parts")
        share = scratch.settle(far.select("s", "v", F.lit(0.0).alias("share")), "share")
        for _ in range(rounds):
            new = part.join(share, ["s", "v"]).groupBy("s", F.col("u").alias("v")).agg(F.sum(F.col("part") * (1 + F.col("share"))).alias("new"))
            share = scratch.settle(share.join(new, ["s", "v"], "left").select("s", "v", F.coalesce("new", F.lit(0.0)).alias("share")), "share")
        total, reached = F.sum("d"), F.count(F.lit(1)) - 1
        near = far.groupBy("s").agg(F.when(total > 0, reached / total * (reached / F.lit(max(n - 1, 1)))).otherwise(0.0).alias("near"))
        near = near.join(far.join(endless, "v").select("s").distinct().withColumn("bad", F.lit(True)), "s", "left")
        rows = share.where("v <> s").select(F.col("v").alias("id"), F.col("share").alias("dependency"), F.lit(0.0).alias("near"))
        rows = rows.unionByName(near.select(F.col("s").alias("id"), F.lit(0.0).alias("dependency"), F.when(F.col("bad"), 0.0).otherwise(F.col("near")).alias("near")))
        done.append(scratch.settle(rows.groupBy("id").agg(F.sum("dependency").alias("dependency"), F.sum("near").alias("near")), "batch"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return nodes.select("id").join(found, "id").groupBy("id").agg((F.sum("dependency") * scale).alias("betweenness_centrality"), F.sum("near").alias("out-closeness"))


def prerequisite_metrics(nodes: DataFrame, edges: DataFrame, small: bool | None = None) -> DataFrame:
    """id, prerequisite_depth, learning_effort over PREREQUISITE edges (any case), with components as units."""
    own = nodes.select("_ord", "id", F.coalesce("difficulty", F.lit(S.DIFFICULTY)).alias("difficulty"))
    chain = edges.where(F.upper("type") == "PREREQUISITE")

    def kernel(g: pd.DataFrame) -> pd.DataFrame:
        ids, links, difficulty = _split(g)
        found = kernels.prerequisites(ids, [(s, t) for s, t, _ in links], difficulty)
        return pd.DataFrame({"id": ids, "prerequisite_depth": [found[v][0] for v in ids], "learning_effort": [found[v][1] for v in ids]})

    made = "id string, prerequisite_depth int, learning_effort double"
    if fixpoint.is_small(own, chain) if small is None else small:
        return _gathered(own, chain).groupBy("one").applyInPandas(kernel, made)
    # Unconnected parts don't touch each other: those of bounded size go to tasks, many at a time.
    own = scratch.settle(own, "own")
    chain = scratch.settle(endpoints_in(chain, own), "chain")
    roots = fixpoint.connected_components(own, chain, False).withColumnRenamed("id", "source")
    rows = scratch.settle(_gathered(own, chain).drop("one").join(roots, "source"), "rows")
    large = scratch.settle(rows.groupBy("root").count().where(F.col("count") > fixpoint.SMALL).select("root"), "large")
    groups = max(1, -(-rows.count() // fixpoint.SMALL))
    out = rows.join(large, "root", "left_anti").withColumn("one", F.pmod(F.xxhash64("root"), F.lit(groups))).groupBy("one").applyInPandas(kernel, made)
    if large.isEmpty():
        return scratch.settle(out, "depths")
    rest = roots.join(large, "root", "left_semi")
    own, chain = own.join(rest.select(F.col("source").alias("id")), "id", "left_semi"), chain.join(rest, "source", "left_semi")
    return scratch.settle(out.unionByName(_prerequisites_by_rounds(own, chain)), "depths")


def _prerequisites_by_rounds(own: DataFrame, chain: DataFrame) -> DataFrame:
    """prerequisite_metrics() by joins, for components of more than a task's memory."""
    scc = scratch.settle(fixpoint.strong_components(own, chain), "scc")
    sums = own.join(scc, "id").groupBy(F.col("scc").alias("id")).agg(F.sum("difficulty").alias("difficulty"))
    name = lambda end: scc.select(F.col("id").alias(end), F.col("scc").alias(end + "_scc"))
    between = chain.join(name("source"), "source").join(name("target"), "target").where("source_scc <> target_scc").select(F.col("source_scc").alias("source"), F.col("target_scc").alias("target"))
    levels = fixpoint.longest_levels(sums, between, "difficulty").withColumnRenamed("id", "scc")
    return scc.join(levels, "scc").select("id", F.col("depth").cast("int").alias("prerequisite_depth"), F.col("total").alias("learning_effort"))


def louvain(nodes: DataFrame, edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """id, cluster_id: communities, found in each connected component by itself and numbered by their least node id.

    A component is one group; components of more than a task's memory need a coarser graph first (top_nodes).
    """
    clean = edges.where("source <> target").withColumn("weight", C.sanitised(F.col("weight")))
    parts = fixpoint.connected_components(nodes, clean).withColumnRenamed("id", "source")
    rows = nodes.select(F.col("id").alias("source"), F.lit(None).cast("string").alias("target"), F.lit(0.0).alias("weight")).unionByName(clean.select("source", "target", "weight")).join(parts, "source")

    def kernel(g: pd.DataFrame) -> pd.DataFrame:
        n, e = g[g["target"].isna()], g[g["target"].notna()].sort_values(["source", "target"])
        found = kernels.communities(sorted(n["source"]), list(zip(e["source"], e["target"], e["weight"], strict=True)), resolution)
        return pd.DataFrame({"id": list(found), "root": g["root"].iloc[0], "own": list(found.values())})

    own = rows.groupBy("root").applyInPandas(kernel, "id string, root string, own int")
    least = own.groupBy("root", "own").agg(F.min("id").alias("least"))
    numbered = least.withColumn("cluster_id", (F.dense_rank().over(W.orderBy("least")) - 1).cast("int"))  # one row per cluster
    return own.join(numbered, ["root", "own"]).select("id", "cluster_id")


def neighbours(edges: DataFrame) -> DataFrame:
    """id, other: distinct neighbours in either direction, without the node itself."""
    pair = lambda a, b: edges.select(F.col(a).alias("id"), F.col(b).alias("other"))
    return pair("source", "target").unionByName(pair("target", "source")).where("id <> other").distinct()


def bridge_ratio(nodes: DataFrame, edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """id, ratio: the share of a node's neighbours that lie in another cluster; 0 without neighbours."""
    k = clusters.select("id", "cluster_id")
    around = neighbours(edges).join(k, "id").join(k.withColumnsRenamed({"id": "other", "cluster_id": "other_cluster"}), "other")
    ratio = around.groupBy("id").agg(F.avg((F.col("cluster_id") != F.col("other_cluster")).cast("double")).alias("ratio"))
    return nodes.select("id").join(ratio, "id", "left").select("id", F.coalesce("ratio", F.lit(0.0)).alias("ratio"))


def bridge_scores(nodes: DataFrame, edges: DataFrame, clusters: DataFrame, betweenness: DataFrame, weight: float = 0.7) -> DataFrame:
    ratio = bridge_ratio(nodes, edges, clusters)
    return ratio.join(betweenness.select("id", "betweenness_centrality"), "id", "left").select("id", (weight * F.coalesce("betweenness_centrality", F.lit(0.0)) + (1 - weight) * F.col("ratio")).alias("bridge_score"))


def mark_inter_cluster(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """edges with is_inter_cluster_edge, and both cluster ids where it is true; self-loops have null."""
    k = lambda end: clusters.select(F.col("id").alias(end), F.col("cluster_id").alias(end + "_cluster_id"))
    out = edges.join(k("source"), "source", "left").join(k("target"), "target", "left")
    differs = F.coalesce(F.col("source_cluster_id") != F.col("target_cluster_id"), F.lit(False))
    inter = F.when(F.col("source") != F.col("target"), differs)
    return out.withColumn("is_inter_cluster_edge", inter).withColumn("source_cluster_id", F.when(inter, F.col("source_cluster_id"))).withColumn("target_cluster_id", F.when(inter, F.col("target_cluster_id")))


def all_metrics(graph: PropertyGraph, resolution: float = 1.0) -> PropertyGraph:
    """The graph with its node and edge metrics, in the order that each needs of the others."""
    nodes, edges = graph.nodes, scratch.settle(collapse_edges(graph.edges), "collapsed")
    parts = [degrees(nodes, edges), pagerank(nodes, edges), path_metrics(nodes, edges), fixpoint.component_ids(nodes, edges), prerequisite_metrics(nodes, edges), educational_importance(nodes, edges)]
    clean = edges.where("source <> target").withColumn("weight", C.sanitised(F.col("weight")))
    clusters = scratch.settle(louvain(nodes, clean, resolution), "clusters")
    parts.append(clusters)
    made = {c for p in parts for c in p.columns} - {"id"} | {"bridge_score"}
    out = nodes.drop(*made)  # metrics that the input has from before give way
    for p in parts:
        out = out.join(p, "id", "left")
    out = scratch.settle(out, "metrics")
    out = out.join(bridge_scores(nodes, clean, clusters, out), "id", "left")
    per_pair = mark_inter_cluster(edges, clusters).select("source", "target", C.inverse_weight(F.col("weight")).alias("inverse_weight"), "is_inter_cluster_edge", "source_cluster_id", "target_cluster_id")
    return PropertyGraph(out, graph.edges.join(per_pair, ["source", "target"], "left"))
