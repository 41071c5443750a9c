"""Joins, filters, orderings and counts over nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from .. import scratch
from ..functions import columns as C
from ..graph import endpoints_in, first_wins


def dedup_candidates(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("type").isin("Chunk", "Assessment") & ~C.blank(F.col("text")))


def target_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("type").isin("Chunk", "Assessment"))


def type_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def bidirectional(edges: DataFrame, kind: str = "PREREQUISITE") -> DataFrame:
    """source < target of pairs with edges of the kind in both directions."""
    own = edges.where(F.col("type") == kind).select("source", "target").distinct()
    back = own.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return own.where("source < target").join(back, ["source", "target"], "left_semi")


def edges_of_pairs(edges: DataFrame) -> DataFrame:
    """low, high, edges: all edges between two nodes in either direction, those from low to high first."""
    low, high = F.least("source", "target"), F.greatest("source", "target")
    one = F.struct((F.col("source") != low).alias("back"), "_ord", "source", "target", "type", "weight")
    grouped = edges.groupBy(low.alias("low"), high.alias("high")).agg(F.array_sort(F.collect_list(one)).alias("e"))
    return grouped.select("low", "high", F.transform("e", lambda x: F.struct(x["source"].alias("source"), x["target"].alias("target"), x["type"].alias("type"), x["weight"].alias("weight"))).alias("edges"))


def crossing_edges(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """cluster_id, n: edges with exactly one end in the cluster."""
    k = lambda end: clusters.select(F.col("id").alias(end), F.col("cluster_id").alias(end[0]))
    both = edges.join(k("source"), "source", "left").join(k("target"), "target", "left").where("NOT s <=> t")
    ends = both.select(F.explode(F.array("s", "t")).alias("cluster_id")).where("cluster_id IS NOT NULL")
    return ends.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))


def induced(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return endpoints_in(edges, nodes)


def top_nodes(nodes: DataFrame, edges: DataFrame, n: int = 1000, metric: str = "pagerank") -> tuple[DataFrame, DataFrame]:
    """The n nodes that lead by the metric (ties by order), and the edges among them."""
    best = nodes.orderBy(F.desc_nulls_last(metric), "_ord").limit(n)
    return best, induced(best, edges)


def leaders(nodes: DataFrame, metrics: list[str], n: int = 5) -> DataFrame:
    """metric, place, id, value: the first n nodes by each metric."""
    long = nodes.select("_ord", "id", F.explode(F.map_from_arrays(F.array(*map(F.lit, metrics)), F.array(*[F.col(m).cast("double") for m in metrics]))).alias("metric", "value"))
    place = F.row_number().over(W.partitionBy("metric").orderBy(F.desc("value"), "_ord"))
    return long.withColumn("place", place).where(F.col("place") <= n).select("metric", "place", "id", "value")


def course_sequence(nodes: DataFrame) -> DataFrame:
    """seq, id, position, cluster_id: Chunks with a position in their ids, in its order; a missing cluster is 0."""
    at = F.regexp_extract("id", r":c:(\d+)$", 1)
    own = nodes.where((F.col("type") == "Chunk") & (at != "")).withColumn("position", at.cast("int"))
    cluster = F.coalesce("cluster_id", F.lit(0)) if "cluster_id" in nodes.columns else F.lit(0)
    return scratch.in_order(own, "position", "_ord").select((F.col("__n") + 1).cast("int").alias("seq"), "id", "position", cluster.alias("cluster_id"))


def ordered_nodes(nodes: DataFrame) -> DataFrame:
    """place: Concepts by id, then the others in their order."""
    concept = F.col("type") == "Concept"
    return scratch.in_order(nodes, ~concept, F.when(concept, F.col("id")), "_ord").withColumn("place", (F.col("__n") + 1).cast("int")).drop("__n")


def search(nodes: DataFrame, query: str, types: tuple[str, ...] = S.NODE_TYPES) -> DataFrame:
    """Nodes of the types whose id, text or definition holds the query, in any case."""
    q = F.lit(query.lower())
    holds = lambda c: F.coalesce(F.contains(F.lower(F.col(c)), q), F.lit(False))
    return nodes.where(F.col("type").isin(*types) & (holds("id") | holds("text") | holds("definition")))


def visible_edges(nodes: DataFrame, edges: DataFrame, types: tuple[str, ...], tiers: tuple[str, ...]) -> DataFrame:
    """Edges of the tiers whose ends are both nodes of the types."""
    return endpoints_in(edges.where(C.tier(F.col("type")).isin(*tiers)), nodes.where(F.col("type").isin(*types)))


def node_edges(edges: DataFrame, node_id: str) -> DataFrame:
    """A node's edges by the order of their types, then weight."""
    rank = F.array_position(F.array(*map(F.lit, S.EDGE_TYPES)), F.col("type"))
    own = edges.where((F.col("source") == node_id) | (F.col("target") == node_id))
    return own.withColumn("place", F.row_number().over(W.orderBy(rank, F.desc("weight"), "_ord")))


def display(nodes: DataFrame) -> DataFrame:
    """id, label, size, opacity as a viewer draws them."""
    return nodes.select("id", C.shortened(F.col("text"), 30).alias("label"), C.node_size(F.col("pagerank")).alias("size"), C.opacity(F.coalesce("difficulty", F.lit(S.DIFFICULTY))).alias("opacity"))


def running_offsets(lengths: DataFrame, by: str, order: str, length: str) -> DataFrame:
    """slice_token_start and _end: sums of the lengths before, from 0 in each group."""
    before = W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(before), F.lit(0))
    return lengths.withColumn("slice_token_start", start).withColumn("slice_token_end", start + F.col(length))


def gaps(slices: DataFrame, by: str, order: str) -> DataFrame:
    """Slices that do not start where the one before them ends."""
    last = F.lag("slice_token_end").over(W.partitionBy(by).orderBy(order))
    return slices.withColumn("expected", F.coalesce(last, F.lit(0))).where("slice_token_start <> expected")


def slice_of(positions: DataFrame, slices: DataFrame, width: int = 4096) -> DataFrame:
    """positions (slug, position) with the id of the slice that holds each: start <= position < end.

    Slices are listed under each cell of `width` tokens that they touch, so the lookup is an equi-join.
    """
    cell = lambda x: F.floor(x / width)
    listed = slices.where("slice_token_end > slice_token_start").select(F.col("id").alias("slice_id"), "slug", "slice_token_start", "slice_token_end", F.explode(F.sequence(cell(F.col("slice_token_start")), cell(F.col("slice_token_end") - 1))).alias("cell"))
    found = positions.withColumn("cell", cell(F.col("position"))).join(listed, ["slug", "cell"]).where("position >= slice_token_start AND position < slice_token_end")
    return found.drop("cell", "slice_token_start", "slice_token_end")


def padded(number: Column, largest: Column) -> Column:
    """A number with zeros before it, as wide as the largest."""
    return F.lpad(number.cast("string"), F.length(largest.cast("string")), F.lit("0"))


def unpivot(df: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """key, metric, value with a row for each value that is there."""
    pairs = F.map_from_arrays(F.array(*map(F.lit, metrics)), F.array(*[F.col(f"`{m}`").cast("double") for m in metrics]))
    return df.select(key, F.explode(pairs).alias("metric", "value")).where("value IS NOT NULL")


__all__ = ["first_wins", *[k for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__]]
