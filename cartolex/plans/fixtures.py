"""Graphs made of the driver's tables, each as DataFrames and as the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from .. import scratch
from ..graph import PropertyGraph


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of trade()."""
    k, name = F.col("n_nationkey"), F.initcap("n_name")
    about = F.concat(F.lit("about "), name)
    return table(spark, sf_dir, "nation").select(
        k.cast("long").alias("_ord"),
        F.concat(F.lit("n:c:"), k).alias("id"),
        F.element_at(F.array(*map(F.lit, S.NODE_TYPES)), k % 3 + 1).alias("type"),
        F.col("n_name").alias("text"),
        k.alias("node_offset"),
        F.when(k % 4 == 0, about).when(k % 4 == 1, F.concat(F.lit("[added_by=LLM] "), about)).when(k % 4 == 2, F.lit("  ")).alias("definition"),
        (k % 5 + 1).cast("int").alias("difficulty"),
        F.col("n_regionkey").cast("int").alias("cluster_id"),
    )


def trade(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Nations as nodes; an edge from a supplier's nation to each customer's nation that it sells to."""
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", "l_suppkey")
    orders = t("orders").select("o_orderkey", "o_custkey")
    supplier, customer = t("supplier").select("s_suppkey", "s_nationkey"), t("customer").select("c_custkey", "c_nationkey")
    # The fact tables are summed down to (order, nation) and so on before the next join meets them.
    sold = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey", "s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    bought = sold.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "s_nationkey").agg(F.sum("n").alias("n"))
    pairs = bought.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("s_nationkey").alias("s"), F.col("c_nationkey").alias("t")).agg(F.sum("n").alias("n"))
    s, d = F.col("s"), F.col("t")
    mix = (s * 25 + d) % 4
    pairs = scratch.settle(pairs, "pairs")  # a row for two nations: the tables are joined once, however often edges are used
    most = pairs.agg(F.max("n").alias("most"))
    edges = pairs.crossJoin(F.broadcast(most)).select(  # one row on the right
        (s * 25 + d).cast("long").alias("_ord"),
        F.concat(F.lit("n:c:"), s).alias("source"),
        F.concat(F.lit("n:c:"), d).alias("target"),
        F.element_at(F.array(*map(F.lit, S.EDGE_TYPES)), (s * 3 + d) % 9 + 1).alias("type"),
        (F.col("n") / F.col("most")).alias("weight"),
        F.when(mix == 0, F.concat(F.lit("see "), d)).when(mix == 1, "added_by=x").when(mix == 2, "  ").alias("conditions"),
    )
    return PropertyGraph(nations(spark, sf_dir), edges)


TRADE_SQL = f"""
nodes AS (SELECT n_nationkey::BIGINT AS _ord, 'n:c:' || n_nationkey AS id, ['Chunk','Concept','Assessment'][n_nationkey % 3 + 1] AS type,
  n_name AS text, n_nationkey AS node_offset,
  CASE n_nationkey % 4 WHEN 0 THEN 'about ' || upper(n_name[1]) || lower(n_name[2:]) WHEN 1 THEN '[added_by=LLM] about ' || upper(n_name[1]) || lower(n_name[2:]) WHEN 2 THEN '  ' END AS definition,
  (n_nationkey % 5 + 1)::INTEGER AS difficulty, n_regionkey::INTEGER AS cluster_id FROM nation),
pairs AS (SELECT s_nationkey AS s, c_nationkey AS t, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
edges AS (SELECT (s * 25 + t)::BIGINT AS _ord, 'n:c:' || s AS source, 'n:c:' || t AS target,
  [{", ".join(f"'{x}'" for x in S.EDGE_TYPES)}][(s * 3 + t) % 9 + 1] AS type, n / (SELECT max(n) FROM pairs) AS weight,
  CASE (s * 25 + t) % 4 WHEN 0 THEN 'see ' || t WHEN 1 THEN 'added_by=x' WHEN 2 THEN '  ' END AS conditions FROM pairs)
"""


def purchases(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Parts as nodes; an edge from each line's part to that of the next line of its order."""
    t = lambda n: table(spark, sf_dir, n)
    k = F.col("p_partkey")
    nodes = t("part").select(k.cast("long").alias("_ord"), F.concat(F.lit("p:c:"), k).alias("id"), F.element_at(F.array(*map(F.lit, S.NODE_TYPES)), (k % 3 + 1).cast("int")).alias("type"), F.col("p_name").alias("text"), (k % 5 + 1).cast("int").alias("difficulty"))
    own = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    steps = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").withColumn("next", F.lead("l_partkey").over(own))
    steps = steps.where("next IS NOT NULL AND next <> l_partkey")
    pairs = steps.groupBy(F.col("l_partkey").alias("s"), F.col("next").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    edges = pairs.select((F.col("s") * 1_000_000_000 + F.col("t")).alias("_ord"), F.concat(F.lit("p:c:"), "s").alias("source"), F.concat(F.lit("p:c:"), "t").alias("target"), F.lit("PREREQUISITE").alias("type"), (1.0 / (1 + F.col("n"))).alias("weight"))
    return PropertyGraph(nodes, edges)


PURCHASES_SQL = """
nodes AS (SELECT p_partkey AS _ord, 'p:c:' || p_partkey AS id, ['Chunk','Concept','Assessment'][p_partkey % 3 + 1] AS type, p_name AS text, (p_partkey % 5 + 1)::INTEGER AS difficulty FROM part),
steps AS (SELECT l_partkey AS s, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS t FROM lineitem),
edges AS (SELECT s * 1000000000 + t AS _ord, 'p:c:' || s AS source, 'p:c:' || t AS target, 'PREREQUISITE' AS type, 1.0::DOUBLE / (1 + count(*)) AS weight
  FROM steps WHERE t IS NOT NULL AND s <> t GROUP BY s, t)
"""


def dialogue(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Conversation turns as nodes; each is a prerequisite of the next one, and of the one two further on."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"), F.min("role").alias("role"))
    name = lambda turn: F.concat(F.lit("v"), F.col("conv_id"), F.lit(":c:"), turn)
    nodes = t.select((F.col("conv_id") * 10_000 + F.col("turn")).alias("_ord"), name(F.col("turn")).alias("id"), F.lit("Chunk").alias("type"), "text", (F.col("turn") % 5 + 1).cast("int").alias("difficulty"))
    turns = t.select("conv_id", "turn")
    edges = None
    for step in (1, 2):
        other = turns.select("conv_id", (F.col("turn") - step).alias("turn"))
        e = turns.join(other, ["conv_id", "turn"]).select((F.col("conv_id") * 20_000 + F.col("turn") * 2 + step).alias("_ord"), name(F.col("turn")).alias("source"), name(F.col("turn") + step).alias("target"), F.lit("PREREQUISITE").alias("type"), F.lit(1.0).alias("weight"))
        edges = e if edges is None else edges.unionByName(e)
    return PropertyGraph(nodes, edges)


DIALOGUE_SQL = """
t AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY 1, 2),
nodes AS (SELECT conv_id * 10000 + turn AS _ord, 'v' || conv_id || ':c:' || turn AS id, 'Chunk' AS type, text, (turn % 5 + 1)::INTEGER AS difficulty FROM t),
edges AS (SELECT a.conv_id * 20000 + a.turn * 2 + (b.turn - a.turn) AS _ord, 'v' || a.conv_id || ':c:' || a.turn AS source, 'v' || b.conv_id || ':c:' || b.turn AS target,
  'PREREQUISITE' AS type, 1.0::DOUBLE AS weight FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn - a.turn IN (1, 2))
"""


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concept dictionary: the words that four documents or more open with."""
    words = table(spark, sf_dir, "documents").select(F.lower(F.regexp_extract("text", r"^([A-Za-z]{3,12})[ .,]", 1)).alias("w")).where("length(w) >= 3").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return words.where("n >= 4").select(F.concat(F.lit("d:p:"), "w").alias("concept_id"), F.struct(F.col("w").alias("primary"), F.array(F.concat(F.col("w"), F.lit("s"))).alias("aliases")).alias("term"), F.concat(F.lit("opens "), F.col("n"), F.lit(" documents")).alias("definition"))


CONCEPTS_SQL = r"""
words AS (SELECT lower(regexp_extract(text, '^([A-Za-z]{3,12})[ .,]', 1)) AS w, count(*) AS n FROM documents GROUP BY 1),
concepts AS (SELECT 'd:p:' || w AS concept_id, w AS "primary", [w || 's'] AS aliases, 'opens ' || n || ' documents' AS definition FROM words WHERE length(w) >= 3 AND n >= 4)
"""
