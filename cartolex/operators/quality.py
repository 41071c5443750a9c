"""Schema rules, invariants, anomaly checks, statistics, and the comparison with expected values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .. import scratch
from ..graph import PropertyGraph
from . import relational

CRITICAL, WARNING = "critical", "warning"


def _violations(df: DataFrame, entity: str, key: Column, rules: dict[str, Column]) -> DataFrame:
    """rule, entity, key: a row for each rule that a row breaks (null counts as kept)."""
    broken = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]), lambda x: x.isNotNull())
    return df.select(F.explode(broken).alias("rule"), F.lit(entity).alias("entity"), key.alias("key"))


def schema_violations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = {
        "id_missing": F.col("id").isNull(),
        "id_pattern": ~F.col("id").rlike(S.ID_PATTERN),
        "type": F.col("type").isNull() | ~F.col("type").isin(*S.NODE_TYPES),
        "text_missing": F.col("text").isNull(),
        "offset": F.col("node_offset") < 0 if "node_offset" in nodes.columns else F.lit(False),
        "difficulty": ~F.col("difficulty").between(1, 5),
    }
    e = {"source_missing": F.col("source").isNull(), "target_missing": F.col("target").isNull(), "type": F.col("type").isNull() | ~F.col("type").isin(*S.EDGE_TYPES), "weight": ~F.col("weight").between(0, 1)}
    return _violations(nodes, "node", F.col("id"), n).unionByName(_violations(edges, "edge", F.concat_ws(">", "source", "target"), e))


def invariant_violations(nodes: DataFrame, edges: DataFrame, concepts_repeat: bool = False) -> DataFrame:
    """rule, entity, key: repeated ids (of Concepts too unless they may repeat), ends without a node, PREREQUISITE
    self-loops, repeated (source, target, type)."""
    row = lambda df, rule, entity, key: df.select(F.lit(rule).alias("rule"), F.lit(entity).alias("entity"), key.alias("key"))
    own = nodes.where("type <> 'Concept'") if concepts_repeat else nodes
    parts = [row(own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate_id", "node", F.col("id"))]
    pair = F.concat_ws(">", "source", "target")
    for end in ("source", "target"):
        parts.append(row(edges.join(nodes.select(F.col("id").alias(end)).distinct(), end, "left_anti"), f"orphan_{end}", "edge", pair))
    parts.append(row(edges.where("type = 'PREREQUISITE' AND source = target"), "prerequisite_loop", "edge", pair))
    again = edges.groupBy("source", "target", "type").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts.append(row(again, "duplicate_edge", "edge", F.concat_ws(">", "source", "target", "type")))
    return reduce(DataFrame.unionByName, parts)


def dictionary_violations(concepts: DataFrame) -> DataFrame:
    """Repeated concept ids, and aliases that repeat without regard to case."""
    again = concepts.groupBy("concept_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_concept").alias("rule"), F.lit("concept").alias("entity"), F.col("concept_id").alias("key"))
    low = F.transform("term.aliases", F.lower)
    alias = concepts.where(F.size(low) > F.size(F.array_distinct(low))).select(F.lit("duplicate_alias").alias("rule"), F.lit("concept").alias("entity"), F.col("concept_id").alias("key"))
    return again.unionByName(alias)


def _bad(x: Column) -> Column:
    return F.isnan(x) | x.isin(float("inf"), float("-inf"))


def checks(nodes: DataFrame, edges: DataFrame, sum_tolerance: float = 0.01, least_modularity: float = 0.1, least_bridge: float = 0.3) -> DataFrame:
    """severity, check, ok, value: the critical checks and the warnings of a graph with metrics; a row each.

    Each table is read once: the checks are conditional aggregates of one row, made long. Checks whose columns are
    missing are left out, but for the one that says so.
    """
    have = set(nodes.columns)
    col = lambda m: F.col(f"`{m}`").cast("double")
    aggs: dict[str, Column] = {"n": F.count(F.lit(1)).cast("double")}
    for m in ("pagerank", "educational_importance"):
        if m in have:
            aggs["sum_" + m] = F.sum(F.coalesce(col(m), F.lit(0.0)))
    if "component_id" in have:
        aggs |= {"comp_max": F.max(col("component_id")), "comp_min": F.min(col("component_id")), "comp_n": F.countDistinct("component_id").cast("double")}
    if "prerequisite_depth" in have:
        aggs["negative"] = F.count_if(col("prerequisite_depth") < 0).cast("double")
    present = [m for m in S.NODE_METRICS if m in have]
    aggs["bad"] = sum((F.count_if(_bad(col(m))) for m in present), F.lit(0)).cast("double")
    aggs["absent"] = (sum((F.max(F.when(F.col(f"`{m}`").isNull(), 1).otherwise(0)) for m in present), F.lit(0)) + F.lit(len(S.NODE_METRICS) - len(present))).cast("double")
    if "cluster_id" in have:
        aggs |= {"clustered": F.count("cluster_id").cast("double"), "clusters": F.countDistinct("cluster_id").cast("double")}
    if "bridge_score" in have:
        aggs |= {"bridge_out": F.count_if(~col("bridge_score").between(0, 1)).cast("double"), "bridge_some": F.count_if(col("bridge_score") > 0).cast("double")}
    if {"degree_in", "degree_out"} <= have:
        aggs["orphans"] = F.count_if((F.col("degree_in") == 0) & (F.col("degree_out") == 0)).cast("double")
    one = nodes.agg(*[v.alias(k) for k, v in aggs.items()])
    inverse = F.count("inverse_weight") if "inverse_weight" in edges.columns else F.lit(0)
    one = one.crossJoin(edges.agg(F.count(F.lit(1)).cast("double").alias("edges"), inverse.cast("double").alias("inverse")))
    one = one.crossJoin(relational.bidirectional(edges).agg(F.count(F.lit(1)).cast("double").alias("both_ways")))
    one = one.crossJoin(dangling_assessments(nodes, edges).agg(F.count(F.lit(1)).cast("double").alias("dangling")))
    if {"betweenness_centrality", "bridge_score"} <= have:
        one = one.crossJoin(nodes.orderBy(F.desc("betweenness_centrality"), "_ord").limit(10).agg(F.avg("bridge_score").alias("bridge_top")))
    if "cluster_id" in have:
        one = one.crossJoin(cluster_sizes(nodes).where("n = 1").agg(F.count(F.lit(1)).cast("double").alias("singletons")))
    c = set(one.columns)
    v, n = F.col, F.col("n")
    rules: list[tuple[str, str, set[str], Column, Column]] = [
        (CRITICAL, "pagerank_sum", {"sum_pagerank"}, F.abs(v("sum_pagerank") - 1) <= sum_tolerance, v("sum_pagerank")) if "sum_pagerank" in c else None,
        (CRITICAL, "educational_importance_sum", {"sum_educational_importance"}, F.abs(v("sum_educational_importance") - 1) <= sum_tolerance, v("sum_educational_importance")) if "sum_educational_importance" in c else None,
        (CRITICAL, "component_id_sequential", set(), (v("comp_min") == 0) & (v("comp_max") + 1 == v("comp_n")), v("comp_n")) if "comp_n" in c else None,
        (CRITICAL, "prerequisite_depth_positive", set(), v("negative") == 0, v("negative")) if "negative" in c else None,
        (CRITICAL, "nan_inf_values", set(), v("bad") == 0, v("bad")),
        (CRITICAL, "required_metrics", set(), v("absent") == 0, v("absent")),
        (CRITICAL, "inverse_weight", set(), (v("edges") == 0) | (v("inverse") > 0), v("inverse")),
        (CRITICAL, "prerequisite_cycles", set(), v("both_ways") == 0, v("both_ways")),
        (WARNING, "cluster_coverage", set(), v("clustered") == n, v("clustered")) if "clusters" in c else None,
        (WARNING, "modularity", set(), F.lit(1.0) - v("clusters") / n >= least_modularity, F.lit(1.0) - v("clusters") / n) if "clusters" in c else None,
        (WARNING, "bridge_range", set(), v("bridge_out") == 0, v("bridge_out")) if "bridge_out" in c else None,
        (WARNING, "bridge_some", set(), v("bridge_some") > 0, v("bridge_some")) if "bridge_out" in c else None,
        (WARNING, "bridge_top", set(), v("bridge_top") >= least_bridge, v("bridge_top")) if "bridge_top" in c else None,
        (WARNING, "singleton_clusters", set(), v("singletons") == 0, v("singletons")) if "singletons" in c else None,
        (WARNING, "orphan_nodes", set(), v("orphans") == 0, v("orphans")) if "orphans" in c else None,
        (WARNING, "dangling_assessments", set(), v("dangling") == 0, v("dangling")),
    ]
    rows = F.array(*[F.struct(F.lit(r[0]).alias("severity"), F.lit(r[1]).alias("check"), F.coalesce(r[3], F.lit(True)).alias("ok"), r[4].cast("double").alias("value")) for r in rules if r])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def status(found: DataFrame, strict: bool = False) -> DataFrame:
    """status, exit_code of checks()."""
    bad, odd = F.count_if(~F.col("ok") & (F.col("severity") == CRITICAL)), F.count_if(~F.col("ok") & (F.col("severity") == WARNING))
    name = F.when(F.col("bad") > 0, "CRITICAL_ISSUES").when(F.col("odd") > 0, "PASSED_WITH_WARNINGS").otherwise("PASSED")
    code = F.when((F.col("bad") > 0) | ((F.col("odd") > 0) & F.lit(strict)), 1).otherwise(0)
    return found.agg(bad.alias("bad"), odd.alias("odd")).select(name.alias("status"), code.alias("exit_code"))


def dangling_assessments(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.where("type = 'Assessment'").select("id").join(edges.where("type = 'TESTS'").select(F.col("source").alias("id")), "id", "left_anti")


def cluster_sizes(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def distinct_clusters(nodes: DataFrame) -> DataFrame:
    """cluster_id: each that a node has, ascending."""
    return nodes.where("cluster_id IS NOT NULL").select("cluster_id").distinct().orderBy("cluster_id")


def cluster_statistics(nodes: DataFrame, edges: DataFrame, bridge: float = 0.7) -> DataFrame:
    """One row: clusters, nodes whose bridge score is above a threshold, and edges between nodes of different clusters."""
    own = nodes.agg(F.countDistinct("cluster_id").alias("clusters"), F.count_if(F.col("bridge_score") > bridge).alias("bridge_nodes"))
    of = lambda end: nodes.where("cluster_id IS NOT NULL").select(F.col("id").alias(end), F.col("cluster_id").alias("__" + end))
    between = edges.join(of("source"), "source").join(of("target"), "target").agg(F.count_if(F.col("__source") != F.col("__target")).alias("inter_cluster_edges"))
    return own.crossJoin(between)  # one row each


def nodes_by_depth(nodes: DataFrame) -> DataFrame:
    """prerequisite_depth (0 for none), place, id: the nodes of each depth in order, numbered from 1. A depth may hold most
    of the nodes, so its list is rows, numbered over the sorted table."""
    own = nodes.select(F.coalesce("prerequisite_depth", F.lit(0)).alias("prerequisite_depth"), "_ord", "id")
    s = scratch.settle(scratch.in_order(own, "prerequisite_depth", "_ord", "id"), "depths")
    first = s.groupBy("prerequisite_depth").agg(F.min("__n").alias("__first"))
    return s.join(first, "prerequisite_depth").select("prerequisite_depth", (F.col("__n") - F.col("__first") + 1).alias("place"), "id")


def statistics(nodes: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, n, least, most, mean, std (of the population) of the values that are there."""
    return relational.unpivot(nodes, "id", metrics).groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def coverage(nodes: DataFrame) -> DataFrame:
    """type (null for all), n, with_concepts, average: how many nodes name concepts. nodes: id, type, concepts."""
    size = F.size("concepts")
    return nodes.cube("type").agg(F.count(F.lit(1)).alias("n"), F.count_if(size > 0).alias("with_concepts"), F.avg(size).alias("average"))


def outliers_iqr(nodes: DataFrame, metrics: list[str], factor: float = 1.5) -> DataFrame:
    """metric, id, value beyond the fences; quartiles are the sorted values at n // 4 and 3n // 4, from four values on.

    All values are sorted and numbered over the table, so that a quartile is the row of a number.
    """
    long = relational.unpivot(nodes, "id", metrics)
    sorted_ = scratch.settle(scratch.in_order(long.select("metric", "value"), "metric", "value"), "values")
    s = sorted_.groupBy("metric").agg(F.min("__n").alias("first"), F.count(F.lit(1)).alias("n")).where("n >= 4")
    at = lambda k: F.col("__n") == F.col("first") + F.floor(k * F.col("n") / 4)
    q = sorted_.join(F.broadcast(s), "metric").where(at(1) | at(3)).groupBy("metric").agg(F.min(F.when(at(1), F.col("value"))).alias("q1"), F.min(F.when(at(3), F.col("value"))).alias("q3"))  # s: one row per metric
    iqr = F.col("q3") - F.col("q1")
    return long.join(F.broadcast(q), "metric").where((F.col("value") < F.col("q1") - factor * iqr) | (F.col("value") > F.col("q3") + factor * iqr)).select("metric", "id", "value")  # one row per metric


def outliers_sigma(nodes: DataFrame, metrics: list[str], factor: float = 3.0) -> DataFrame:
    long = relational.unpivot(nodes, "id", metrics)
    s = long.groupBy("metric").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return long.join(F.broadcast(s), "metric").where((F.col("s") > 0) & (F.abs(F.col("value") - F.col("m")) > factor * F.col("s"))).select("metric", "id", "value")


def compare(actual: DataFrame, expected: DataFrame, metrics: list[str], tolerance: float = 0.01, at_zero: float = 0.001) -> DataFrame:
    """graph, id, metric, expected, actual, status (pass, fail, missing, unexpected): values within a relative tolerance, or
    an absolute one where 0 is expected; missing is what only expected has, unexpected what only actual has. Both: graph,
    id and metric columns."""
    key = F.struct("graph", "id").alias("k")
    long = lambda df, name: relational.unpivot(df.withColumn("k", key), "k", [m for m in metrics if m in df.columns]).select("k.graph", "k.id", "metric", F.col("value").alias(name))
    both = long(expected, "expected").join(long(actual, "actual"), ["graph", "id", "metric"], "full")
    near = F.when(F.col("expected") == 0, F.abs("actual") <= at_zero).otherwise(F.abs(F.col("actual") - F.col("expected")) <= tolerance * F.abs("expected"))
    return both.withColumn("status", F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(near, "pass").otherwise("fail"))


def validation_matrix(compared: DataFrame, metrics: list[str]) -> DataFrame:
    """graph and, for each metric, the share of passes (null if nothing was compared)."""
    return compared.groupBy("graph").pivot("metric", metrics).agg(F.avg((F.col("status") == "pass").cast("double")))


def graph_status(graph: PropertyGraph) -> DataFrame:
    return status(checks(graph.nodes, graph.edges))
