"""A property graph: two DataFrames, nodes and edges, whose _ord keeps the order of the source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import schema as S


@dataclass(frozen=True)
class PropertyGraph:
    nodes: DataFrame
    edges: DataFrame

    @staticmethod
    def of(spark: SparkSession, nodes: list[tuple], edges: list[tuple]) -> PropertyGraph:
        """From (id, type, difficulty) and (source, target, type, weight), in order; for tests and small inputs."""
        n = spark.createDataFrame([(i, *x) for i, x in enumerate(nodes)], "_ord BIGINT, id STRING, type STRING, difficulty INT")
        e = spark.createDataFrame([(i, *x) for i, x in enumerate(edges)], "_ord BIGINT, source STRING, target STRING, type STRING, weight DOUBLE")
        return PropertyGraph(n, e)

    def collapsed(self) -> DataFrame:
        return collapse_edges(self.edges)


def collapse_edges(edges: DataFrame) -> DataFrame:
    """One edge for each (source, target): the last in order gives its type and weight (1.0 if missing)."""
    last = F.max_by(F.struct(*[c for c in edges.columns if c not in ("source", "target")]), "_ord").alias("e")
    out = edges.groupBy("source", "target").agg(last).select("source", "target", "e.*")
    return out.withColumn("weight", F.coalesce("weight", F.lit(S.WEIGHT_METRICS)))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def endpoints_in(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges whose source and target are both among ids (id)."""
    for end in ("source", "target"):
        edges = edges.join(ids.select(F.col("id").alias(end)).distinct(), end, "left_semi")
    return edges.select("_ord", "source", "target", *[c for c in edges.columns if c not in ("_ord", "source", "target")]) if "_ord" in edges.columns else edges
