"""Filters, joins, aggregates, windows and checks on the trade graph (see fixtures.trade)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..graph import collapse_edges
from ..operators import centrality, enrich, quality, refine, relational, similarity
from .fixtures import CONCEPTS_SQL, TRADE_SQL, concepts, nations, table, trade
from .registry import query

T = f"WITH {TRADE_SQL}"
R = lambda c, n=6: F.round(c, n)
#: A metric that SQL can compute exactly stands in for PageRank where a query only ranks by it.
WEIGHED = "weighed AS (SELECT n.*, round(coalesce((SELECT sum(weight) FROM edges e WHERE e.target = n.id), 0), 6) AS pagerank FROM nodes n)"


def weighed(g):
    w = g.edges.groupBy(F.col("target").alias("id")).agg(F.sum("weight").alias("w"))
    return g.nodes.join(w, "id", "left").withColumn("pagerank", R(F.coalesce("w", F.lit(0.0)))).drop("w")


@query("q_degree", f"""{T}, d AS (SELECT n.id, (SELECT count(*) FROM edges e WHERE e.target = n.id) AS i, (SELECT count(*) FROM edges e WHERE e.source = n.id) AS o FROM nodes n)
SELECT id, i::INTEGER AS degree_in, o::INTEGER AS degree_out, round((i + o) / ((SELECT count(*) FROM nodes) - 1), 6) AS degree_centrality FROM d""")
def q_degree(spark, d):
    g = trade(spark, d)
    return centrality.degrees(g.nodes, g.collapsed()).withColumn("degree_centrality", R("degree_centrality"))


@query("q_inverse_weight", f"{T} SELECT source, target, round(CASE WHEN weight > 0 THEN 1.0 / weight ELSE 'inf'::DOUBLE END, 6) AS inverse_weight FROM edges")
def q_inverse_weight(spark, d):
    return trade(spark, d).edges.select("source", "target", R(C.inverse_weight(F.col("weight"))).alias("inverse_weight"))


@query("q_sanitised_weights", f"{T} SELECT source, target, round(CASE WHEN weight - 0.9 > 0 THEN weight - 0.9 ELSE 1e-9 END, 9) AS weight FROM edges WHERE source <> target")
def q_sanitised_weights(spark, d):
    return trade(spark, d).edges.where("source <> target").select("source", "target", R(C.sanitised(F.col("weight") - 0.9), 9).alias("weight"))


@query("q_safe_metric", f"{T} SELECT id, CASE WHEN difficulty = 1 THEN 0.0 WHEN difficulty = 2 THEN 0.0 WHEN difficulty = 3 THEN 0.0 ELSE difficulty::DOUBLE END AS x FROM nodes")
def q_safe_metric(spark, d):
    k = F.col("difficulty")
    x = F.when(k == 1, F.lit(float("nan"))).when(k == 2, F.lit(float("-inf"))).when(k == 3, F.lit(None)).otherwise(k.cast("double"))
    return nations(spark, d).select("id", C.safe_metric(x).alias("x"))


@query("q_type_counts", f"{T} SELECT 'node' AS kind, type, count(*) AS n FROM nodes GROUP BY 2 UNION ALL SELECT 'edge', type, count(*) FROM edges GROUP BY 2")
def q_type_counts(spark, d):
    g = trade(spark, d)
    k = lambda df, kind: relational.type_counts(df).select(F.lit(kind).alias("kind"), "type", "n")
    return k(g.nodes, "node").unionByName(k(g.edges, "edge"))


EDU = ", ".join(f"'{x}'" for x in S.EDUCATIONAL)


@query("q_edu_subgraph", f"{T} SELECT source, target, type FROM edges WHERE upper(type) IN ({EDU})")
def q_edu_subgraph(spark, d):
    return centrality.educational(trade(spark, d).edges).select("source", "target", "type")


@query("q_edu_subgraph_exact", f"{T} SELECT source, target FROM (SELECT source, target, CASE WHEN _ord % 2 = 0 THEN lower(type) ELSE type END AS type FROM edges) WHERE type IN ({EDU})")
def q_edu_subgraph_exact(spark, d):
    e = trade(spark, d).edges.withColumn("type", F.when(F.col("_ord") % 2 == 0, F.lower("type")).otherwise(F.col("type")))
    return centrality.educational(e, fold_case=False).select("source", "target")


@query("q_dedup_candidates", f"{T} SELECT id FROM (SELECT id, type, definition AS text FROM nodes) WHERE type IN ('Chunk', 'Assessment') AND text IS NOT NULL AND trim(text) <> ''")
def q_dedup_candidates(spark, d):
    return relational.dedup_candidates(nations(spark, d).withColumn("text", F.col("definition"))).select("id")


@query("q_target_nodes", f"{T} SELECT id FROM nodes WHERE type IN ('Chunk', 'Assessment')")
def q_target_nodes(spark, d):
    return relational.target_nodes(nations(spark, d)).select("id")


@query("q_edges_semi", f"{T}, k AS (SELECT id FROM nodes WHERE type <> 'Concept') SELECT source, target, type FROM edges WHERE source IN (SELECT id FROM k) AND target IN (SELECT id FROM k)")
def q_edges_semi(spark, d):
    g = trade(spark, d)
    return relational.induced(g.nodes.where("type <> 'Concept'"), g.edges).select("source", "target", "type")


MAP = "map AS (SELECT 'n:c:' || n_nationkey AS duplicate_id, 'n:c:' || n_nationkey // 2 AS master_id FROM nation WHERE n_nationkey % 4 = 3)"


def nation_map(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").where(k % 4 == 3).select(F.concat(F.lit("n:c:"), k).alias("duplicate_id"), F.concat(F.lit("n:c:"), F.floor(k / 2)).alias("master_id"))


@query("q_nodes_anti", f"{T}, {MAP} SELECT id, type FROM nodes WHERE id NOT IN (SELECT duplicate_id FROM map)")
def q_nodes_anti(spark, d):
    g = trade(spark, d)
    return g.nodes.join(nation_map(spark, d).select(F.col("duplicate_id").alias("id")), "id", "left_anti").select("id", "type")


@query("q_rewrite_edges", f"""{T}, {MAP}, kept AS (SELECT id FROM nodes WHERE id NOT IN (SELECT duplicate_id FROM map)),
moved AS (SELECT _ord, coalesce(a.master_id, source) AS source, coalesce(b.master_id, target) AS target, type, round(weight, 6) AS weight FROM edges LEFT JOIN map a ON source = a.duplicate_id LEFT JOIN map b ON target = b.duplicate_id)
SELECT source, target, type, weight FROM (SELECT *, row_number() OVER (PARTITION BY source, target, type ORDER BY _ord) AS r FROM moved WHERE source IN (FROM kept) AND target IN (FROM kept)) WHERE r = 1""")
def q_rewrite_edges(spark, d):
    g = trade(spark, d)
    _, e = similarity.rewrite(g.nodes, g.edges, nation_map(spark, d))
    return e.select("source", "target", "type", R("weight").alias("weight"))


@query("q_rewrite_stats", f"""{T}, {MAP}, kept AS (SELECT id FROM nodes WHERE id NOT IN (SELECT duplicate_id FROM map)),
moved AS (SELECT DISTINCT coalesce(a.master_id, source) AS source, coalesce(b.master_id, target) AS target, type FROM edges LEFT JOIN map a ON source = a.duplicate_id LEFT JOIN map b ON target = b.duplicate_id)
SELECT (SELECT count(*) FROM nodes) AS nodes_before, (SELECT count(*) FROM kept) AS nodes_after, (SELECT count(*) FROM edges) AS edges_before,
 (SELECT count(*) FROM moved WHERE source IN (FROM kept) AND target IN (FROM kept)) AS edges_after, (SELECT count(*) FROM map) AS duplicates""")
def q_rewrite_stats(spark, d):
    g, m = trade(spark, d), nation_map(spark, d)
    return similarity.rewrite_stats(g.nodes, g.edges, *similarity.rewrite(g.nodes, g.edges, m), m)


@query("q_collapse_edges", f"{T}, two AS (SELECT _ord, source, target, type, weight FROM edges UNION ALL SELECT _ord + 1000, source, target, 'MENTIONS', NULL FROM edges WHERE _ord % 3 = 0) SELECT source, target, arg_max(type, _ord) AS type, round(coalesce(arg_max_null(weight, _ord), 1.0), 6) AS weight FROM two GROUP BY 1, 2")
def q_collapse_edges(spark, d):
    e = trade(spark, d).edges.select("_ord", "source", "target", "type", "weight")
    more = e.where("_ord % 3 = 0").select((F.col("_ord") + 1000).alias("_ord"), "source", "target", F.lit("MENTIONS").alias("type"), F.lit(None).cast("double").alias("weight"))
    return collapse_edges(e.unionByName(more)).select("source", "target", "type", R("weight").alias("weight"))


@query("q_bidirectional", f"{T} SELECT DISTINCT a.source, a.target FROM (SELECT source, target FROM edges) a JOIN edges b ON a.source = b.target AND a.target = b.source WHERE a.source < a.target")
def q_bidirectional(spark, d):
    return relational.bidirectional(trade(spark, d).edges.withColumn("type", F.lit("PREREQUISITE")))


@query("q_existing_edges", f"""{T} SELECT least(source, target) AS low, greatest(source, target) AS high,
 string_agg(source || '>' || target || ':' || type, ',' ORDER BY (source <> least(source, target)), _ord) AS edges FROM edges GROUP BY 1, 2""")
def q_existing_edges(spark, d):
    text = F.transform("edges", lambda e: F.concat(e["source"], F.lit(">"), e["target"], F.lit(":"), e["type"]))
    return relational.edges_of_pairs(trade(spark, d).edges).select("low", "high", F.array_join(text, ",").alias("edges"))


INTER = "marked AS (SELECT e.*, s.cluster_id AS s, t.cluster_id AS t FROM edges e JOIN nodes s ON source = s.id JOIN nodes t ON target = t.id)"


@query("q_inter_cluster_mark", f"{T}, {INTER} SELECT source, target, CASE WHEN source <> target THEN s <> t END AS is_inter_cluster_edge, CASE WHEN source <> target AND s <> t THEN s END AS source_cluster_id, CASE WHEN source <> target AND s <> t THEN t END AS target_cluster_id FROM marked")
def q_inter_cluster_mark(spark, d):
    g = trade(spark, d)
    return centrality.mark_inter_cluster(g.edges, g.nodes).select("source", "target", "is_inter_cluster_edge", "source_cluster_id", "target_cluster_id")


@query("q_xor_edges", f"{T}, {INTER} SELECT k AS cluster_id, count(*) AS n FROM (SELECT s AS k FROM marked WHERE s <> t UNION ALL SELECT t FROM marked WHERE s <> t) GROUP BY 1")
def q_xor_edges(spark, d):
    g = trade(spark, d)
    return relational.crossing_edges(g.edges, g.nodes)


@query("q_inter_links_top3", f"""{T}, {WEIGHED}, l AS (SELECT e._ord, e.source, e.target, e.type, round(e.weight, 6) AS weight, s.type AS st, t.type AS tt, s.cluster_id AS sc, t.cluster_id AS tc, s.pagerank AS imp
 FROM edges e JOIN weighed s ON e.source = s.id JOIN weighed t ON e.target = t.id WHERE e.type IN ('PREREQUISITE', 'ELABORATES', 'EXAMPLE_OF', 'TESTS') AND s.cluster_id <> t.cluster_id
 AND CASE WHEN e.type = 'TESTS' THEN s.type = 'Assessment' ELSE s.type = 'Concept' OR t.type = 'Concept' END),
v AS (SELECT tc AS cluster_id, 'incoming' AS direction, sc AS other_cluster, * FROM l UNION ALL SELECT sc, 'outgoing', tc, * FROM l)
SELECT cluster_id, direction, place::INTEGER AS place, source, target, type, weight, other_cluster FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id, direction ORDER BY imp DESC, _ord) AS place FROM v) WHERE place <= 3""")
def q_inter_links_top3(spark, d):
    g = trade(spark, d)
    n = weighed(g).withColumnRenamed("pagerank", "educational_importance")
    return enrich.inter_cluster_links(n, g.edges).select("cluster_id", "direction", "place", "source", "target", "type", R("weight").alias("weight"), "other_cluster")


CONCEPTS = "named AS (SELECT n.cluster_id, c.id AS concept_id FROM nodes n JOIN edges e ON e.source = n.id JOIN nodes c ON c.id = e.target AND c.type = 'Concept' UNION SELECT n.cluster_id, c.id FROM nodes n JOIN edges e ON e.target = n.id JOIN nodes c ON c.id = e.source AND c.type = 'Concept')"


@query("q_cluster_concepts", f"{T}, {CONCEPTS} SELECT DISTINCT k.cluster_id, concept_id, lower(c.text) AS \"primary\", c.cluster_id AS own_cluster FROM named k JOIN nodes c ON c.id = concept_id")
def q_cluster_concepts(spark, d):
    g = trade(spark, d)
    n = g.nodes.join(enrich.node_concepts(g.nodes, g.edges), "id")
    dictionary = g.nodes.where("type = 'Concept'").select(F.col("id").alias("concept_id"), F.struct(F.lower("text").alias("primary")).alias("term"))
    return enrich.cluster_concepts(n, dictionary)


@query("q_concept_text", f"{T} SELECT id, CASE WHEN type = 'Concept' AND node_offset % 2 = 0 THEN lower(text) || ' (' || text || ', x)' WHEN type = 'Concept' THEN text ELSE text END AS text FROM nodes")
def q_concept_text(spark, d):
    g = trade(spark, d)
    own = g.nodes.where("type = 'Concept' AND node_offset % 2 = 0").select(F.col("id").alias("concept_id"), F.struct(F.lower("text").alias("primary"), F.array(F.col("text"), F.lit("x")).alias("aliases")).alias("term"))
    n, _ = enrich.fix(g.nodes, g.edges, own)
    return n.select("id", "text")


@query("q_dangling", f"{T} SELECT id FROM nodes WHERE type = 'Assessment' AND id NOT IN (SELECT source FROM edges WHERE type = 'TESTS')")
def q_dangling(spark, d):
    g = trade(spark, d)
    return quality.dangling_assessments(g.nodes, g.edges)


@query("q_orphans", f"{T}, few AS (SELECT * FROM edges WHERE weight > 0.97) SELECT id FROM nodes WHERE id NOT IN (SELECT source FROM few) AND id NOT IN (SELECT target FROM few)")
def q_orphans(spark, d):
    g = trade(spark, d)
    return centrality.degrees(g.nodes, collapse_edges(g.edges.where("weight > 0.97"))).where("degree_in = 0 AND degree_out = 0").select("id")


@query("q_mention_index", f"""{T}, l AS (SELECT c.id AS concept, e.target AS id FROM nodes c JOIN edges e ON e.source = c.id WHERE c.type = 'Concept' UNION SELECT c.id, e.source FROM nodes c JOIN edges e ON e.target = c.id WHERE c.type = 'Concept')
SELECT concept, string_agg(id, ',' ORDER BY id) AS nodes, count(*) AS n FROM l GROUP BY 1""")
def q_mention_index(spark, d):
    g = trade(spark, d)
    return enrich.mention_index(g.nodes, g.edges).withColumn("nodes", F.array_join("nodes", ","))


@query("q_node_concepts", f"""{T}, l AS (SELECT c.id AS concept, e.target AS id FROM nodes c JOIN edges e ON e.source = c.id WHERE c.type = 'Concept' UNION SELECT c.id, e.source FROM nodes c JOIN edges e ON e.target = c.id WHERE c.type = 'Concept')
SELECT n.id, coalesce(string_agg(concept, ',' ORDER BY concept), '') AS concepts FROM nodes n LEFT JOIN l ON l.id = n.id GROUP BY 1""")
def q_node_concepts(spark, d):
    g = trade(spark, d)
    return enrich.node_concepts(g.nodes, g.edges).withColumn("concepts", F.array_join("concepts", ","))


@query("q_bridge_ratio", f"""{T}, a AS (SELECT source AS id, target AS o FROM edges WHERE source <> target UNION SELECT target, source FROM edges WHERE source <> target),
r AS (SELECT a.id, avg((x.cluster_id <> y.cluster_id)::INTEGER) AS ratio FROM a JOIN nodes x ON x.id = a.id JOIN nodes y ON y.id = a.o GROUP BY 1) SELECT n.id, round(coalesce(ratio, 0), 6) AS ratio FROM nodes n LEFT JOIN r ON r.id = n.id""")
def q_bridge_ratio(spark, d):
    g = trade(spark, d)
    return centrality.bridge_ratio(g.nodes, g.edges, g.nodes).withColumn("ratio", R("ratio"))


@query("q_cluster_sizes", f"{T} SELECT cluster_id, count(*) AS n FROM nodes GROUP BY 1")
def q_cluster_sizes(spark, d):
    return quality.cluster_sizes(nations(spark, d))


@query("q_distinct_clusters", f"{T} SELECT DISTINCT node_offset % 7 AS cluster_id FROM nodes WHERE node_offset % 7 <> 3")
def q_distinct_clusters(spark, d):
    k = F.col("node_offset") % 7
    return quality.distinct_clusters(nations(spark, d).withColumn("cluster_id", F.when(k != 3, k)))


@query("q_cluster_statistics", f"{T}, {WEIGHED}, b AS (SELECT id, CASE WHEN node_offset % 7 <> 3 THEN cluster_id END AS k, pagerank / (SELECT max(pagerank) FROM weighed) AS s FROM weighed) SELECT (SELECT count(DISTINCT k) FROM b) AS clusters, (SELECT count(*) FROM b WHERE s > 0.7) AS bridge_nodes, (SELECT count(*) FROM edges e JOIN b x ON x.id = e.source JOIN b y ON y.id = e.target WHERE x.k <> y.k) AS inter_cluster_edges")
def q_cluster_statistics(spark, d):
    g = trade(spark, d)
    n = weighed(g).withColumn("cluster_id", F.when(F.col("node_offset") % 7 != 3, F.col("cluster_id")))
    n = n.crossJoin(n.agg(F.max("pagerank").alias("most"))).withColumn("bridge_score", F.col("pagerank") / F.col("most"))  # one row on the right
    return quality.cluster_statistics(n, g.edges)


@query("q_singletons", f"{T} SELECT k AS cluster_id, count(*) AS n FROM (SELECT node_offset // 2 + difficulty AS k FROM nodes) GROUP BY 1 HAVING count(*) = 1")
def q_singletons(spark, d):
    n = nations(spark, d).select((F.floor(F.col("node_offset") / 2) + F.col("difficulty")).alias("cluster_id"))
    return quality.cluster_sizes(n).where("n = 1")


METRICS = ["difficulty", "pagerank", "node_offset"]
LONG = "long AS (SELECT id, 'difficulty' AS metric, difficulty::DOUBLE AS value FROM weighed UNION ALL SELECT id, 'pagerank', pagerank FROM weighed UNION ALL SELECT id, 'node_offset', node_offset FROM weighed)"


@query("q_metric_stats", f"{T}, {WEIGHED}, {LONG} SELECT metric, count(*) AS n, min(value) AS least, max(value) AS most, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM long GROUP BY 1")
def q_metric_stats(spark, d):
    return quality.statistics(weighed(trade(spark, d)), METRICS).withColumn("mean", R("mean")).withColumn("std", R("std"))


@query("q_coverage", f"""{T}, l AS (SELECT DISTINCT n.id, c.id AS concept FROM nodes n JOIN edges e ON e.source = n.id OR e.target = n.id JOIN nodes c ON c.type = 'Concept' AND ((c.id = e.target AND e.source = n.id) OR (c.id = e.source AND e.target = n.id))),
k AS (SELECT n.id, n.type, count(concept) AS k FROM nodes n LEFT JOIN l ON l.id = n.id GROUP BY 1, 2)
SELECT type, count(*) AS n, count(*) FILTER (k > 0) AS with_concepts, round(avg(k), 6) AS average FROM k GROUP BY CUBE (type)""")
def q_coverage(spark, d):
    g = trade(spark, d)
    return quality.coverage(g.nodes.join(enrich.node_concepts(g.nodes, g.edges), "id")).withColumn("average", R("average"))


@query("q_outliers_iqr", f"""{T}, {WEIGHED}, {LONG}, s AS (SELECT metric, list(value ORDER BY value) AS v FROM long GROUP BY 1), q AS (SELECT metric, v[len(v) // 4 + 1] AS q1, v[3 * len(v) // 4 + 1] AS q3 FROM s WHERE len(v) >= 4)
SELECT metric, id, value FROM long JOIN q USING (metric) WHERE value < q1 - 0.5 * (q3 - q1) OR value > q3 + 0.5 * (q3 - q1)""")
def q_outliers_iqr(spark, d):
    return quality.outliers_iqr(weighed(trade(spark, d)), METRICS, 0.5)


@query("q_outliers_3sigma", f"{T}, {WEIGHED}, {LONG}, s AS (SELECT metric, avg(value) AS m, stddev_pop(value) AS s FROM long GROUP BY 1) SELECT metric, id, value FROM long JOIN s USING (metric) WHERE s > 0 AND abs(value - m) > 1.6 * s")
def q_outliers_3sigma(spark, d):
    return quality.outliers_sigma(weighed(trade(spark, d)), METRICS, 1.6)


@query("q_topn", f"{T}, {WEIGHED}, lead10 AS (SELECT id FROM weighed ORDER BY pagerank DESC, _ord LIMIT 10) SELECT source, target, type FROM edges WHERE source IN (FROM lead10) AND target IN (FROM lead10)")
def q_topn(spark, d):
    g = trade(spark, d)
    return relational.top_nodes(weighed(g), g.edges, 10)[1].select("source", "target", "type")


@query("q_top5", f"{T}, {WEIGHED}, {LONG} SELECT metric, place::INTEGER AS place, id, value FROM (SELECT metric, l.id, value, row_number() OVER (PARTITION BY metric ORDER BY value DESC, n._ord) AS place FROM long l JOIN nodes n ON n.id = l.id) WHERE place <= 5")
def q_top5(spark, d):
    return relational.leaders(weighed(trade(spark, d)), METRICS)


@query("q_course_sequence", f"{T} SELECT row_number() OVER (ORDER BY node_offset)::INTEGER AS seq, id, node_offset AS position, cluster_id FROM nodes WHERE type = 'Chunk'")
def q_course_sequence(spark, d):
    return relational.course_sequence(nations(spark, d))


@query("q_node_order", f"{T} SELECT row_number() OVER (ORDER BY type <> 'Concept', CASE WHEN type = 'Concept' THEN id END, _ord)::INTEGER AS place, id FROM nodes")
def q_node_order(spark, d):
    return relational.ordered_nodes(nations(spark, d)).select("place", "id")


@query("q_showcase_path", f"""{T}, {WEIGHED}, b AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY pagerank DESC, _ord) AS r, min(_ord) OVER (PARTITION BY cluster_id) AS f FROM weighed)
SELECT row_number() OVER (ORDER BY difficulty, f)::INTEGER AS seq, id FROM b WHERE r = 1""")
def q_showcase_path(spark, d):
    return enrich.showcase(weighed(trade(spark, d)).withColumn("prerequisite_depth", F.col("difficulty")), 15)


@query("q_position", f"{T}, i AS (SELECT CASE node_offset % 4 WHEN 0 THEN 's:q:' || node_offset || ':1' WHEN 1 THEN 's:p:name' WHEN 2 THEN 's:c:x' ELSE id END AS id FROM nodes) SELECT id, CASE WHEN split_part(id, ':', 2) IN ('c', 'q') THEN try_cast(split_part(id, ':', 3) AS INTEGER) END AS position FROM i")
def q_position(spark, d):
    k = F.col("node_offset")
    i = F.when(k % 4 == 0, F.concat(F.lit("s:q:"), k, F.lit(":1"))).when(k % 4 == 1, F.lit("s:p:name")).when(k % 4 == 2, F.lit("s:c:x")).otherwise(F.col("id"))
    return nations(spark, d).select(i.alias("id")).withColumn("position", C.position(F.col("id")))


@query("q_mark_definitions", f"{T} SELECT id, CASE WHEN type IN ('Chunk', 'Assessment') AND trim(definition) <> '' AND NOT starts_with(definition, '[added_by=LLM]') THEN '[added_by=LLM] ' || definition ELSE definition END AS definition FROM nodes")
def q_mark_definitions(spark, d):
    return nations(spark, d).select("id", C.marked_definition(F.col("type"), F.col("definition")).alias("definition"))


@query("q_mark_conditions", f"{T} SELECT source, target, CASE WHEN trim(conditions) <> '' AND NOT contains(conditions, 'added_by=') AND NOT contains(conditions, 'fixed_by=') AND NOT contains(conditions, 'auto_generated') THEN '[added_by=LLM] ' || conditions ELSE conditions END AS conditions FROM edges")
def q_mark_conditions(spark, d):
    return trade(spark, d).edges.select("source", "target", C.marked_conditions(F.col("conditions")).alias("conditions"))


@query("q_fix_stats", f"""{T} SELECT (SELECT count(*) FROM nodes WHERE type = 'Chunk' AND node_offset % 4 = 0) AS chunks_marked, (SELECT count(*) FROM nodes WHERE type = 'Assessment' AND node_offset % 4 = 0) AS assessments_marked,
 (SELECT count(*) FROM nodes WHERE type = 'Concept') AS concepts_updated, (SELECT count(*) FROM edges WHERE _ord % 4 = 0) AS edges_marked""")
def q_fix_stats(spark, d):
    g = trade(spark, d)
    own = g.nodes.where("type = 'Concept'").select(F.col("id").alias("concept_id"), F.struct(F.lower("text").alias("primary"), F.array().cast("array<string>").alias("aliases")).alias("term"))
    return enrich.fix_stats(g.nodes, g.edges, *enrich.fix(g.nodes, g.edges, own))


@query("q_search", f"{T} SELECT id FROM nodes WHERE type IN ('Chunk', 'Concept') AND (contains(lower(id), 'an') OR contains(lower(text), 'an') OR coalesce(contains(lower(definition), 'an'), false))")
def q_search(spark, d):
    return relational.search(nations(spark, d), "AN", ("Chunk", "Concept")).select("id")


@query("q_edge_tier", f"{T} SELECT source, target, CASE WHEN type IN ('PREREQUISITE', 'TESTS') THEN 'strong' WHEN type IN ('HINT_FORWARD', 'REFER_BACK', 'MENTIONS') THEN 'weak' ELSE 'medium' END AS tier FROM edges")
def q_edge_tier(spark, d):
    return trade(spark, d).edges.select("source", "target", C.tier(F.col("type")).alias("tier"))


@query("q_visible_edges", f"{T}, k AS (SELECT id FROM nodes WHERE type IN ('Chunk', 'Assessment')) SELECT source, target FROM edges WHERE type NOT IN ('HINT_FORWARD', 'REFER_BACK', 'MENTIONS') AND source IN (FROM k) AND target IN (FROM k)")
def q_visible_edges(spark, d):
    g = trade(spark, d)
    return relational.visible_edges(g.nodes, g.edges, ("Chunk", "Assessment"), ("strong", "medium")).select("source", "target")


@query("q_node_edges", f"{T} SELECT row_number() OVER (ORDER BY list_position([{', '.join(f"'{x}'" for x in S.EDGE_TYPES)}], type), weight DESC, _ord)::INTEGER AS place, source, target FROM edges WHERE 'n:c:3' IN (source, target)")
def q_node_edges(spark, d):
    return relational.node_edges(trade(spark, d).edges, "n:c:3").select("place", "source", "target")


@query("q_node_size", f"{T}, {WEIGHED} SELECT id, text AS label, round(20 + 40 * least(1, ln(1000 * pagerank + 1) / ln(1000)), 6) AS size, round(0.5 + 0.5 * (difficulty - 1) / 4, 6) AS opacity FROM weighed")
def q_node_size(spark, d):
    return relational.display(weighed(trade(spark, d))).withColumn("size", R("size")).withColumn("opacity", R("opacity"))


BROKEN_N = "bn AS (SELECT id, CASE WHEN node_offset % 6 = 0 THEN 'Thing' ELSE type END AS type, text, CASE WHEN node_offset % 7 = 0 THEN 9 ELSE difficulty END AS difficulty FROM nodes UNION ALL SELECT 'a b', 'Chunk', NULL, 3)"
BROKEN_E = "be AS (SELECT source, CASE WHEN _ord % 5 = 0 THEN 'gone' ELSE target END AS target, type, CASE WHEN _ord % 4 = 0 THEN weight + 1 ELSE weight END AS weight FROM edges UNION ALL SELECT source, source, 'PREREQUISITE', 0.5 FROM edges WHERE _ord % 50 = 1)"


def broken(spark, d):
    g = trade(spark, d)
    n = g.nodes.select("id", F.when(F.col("node_offset") % 6 == 0, "Thing").otherwise(F.col("type")).alias("type"), "text", F.when(F.col("node_offset") % 7 == 0, 9).otherwise(F.col("difficulty")).alias("difficulty"))
    n = n.unionByName(spark.createDataFrame([("a b", "Chunk", None, 3)], n.schema))
    e = g.edges.select("source", F.when(F.col("_ord") % 5 == 0, "gone").otherwise(F.col("target")).alias("target"), "type", F.when(F.col("_ord") % 4 == 0, F.col("weight") + 1).otherwise(F.col("weight")).alias("weight"))
    loops = g.edges.where("_ord % 50 = 1").select("source", F.col("source").alias("target"), F.lit("PREREQUISITE").alias("type"), F.lit(0.5).alias("weight"))
    return n, e.unionByName(loops)


@query("q_schema_violations", f"""{T}, {BROKEN_N}, {BROKEN_E} SELECT 'id_pattern' AS rule, 'node' AS entity, id AS key FROM bn WHERE NOT regexp_matches(id, '^[A-Za-z0-9:_-]+$') UNION ALL SELECT 'type', 'node', id FROM bn WHERE type NOT IN ('Chunk', 'Concept', 'Assessment')
UNION ALL SELECT 'text_missing', 'node', id FROM bn WHERE text IS NULL UNION ALL SELECT 'difficulty', 'node', id FROM bn WHERE difficulty NOT BETWEEN 1 AND 5 UNION ALL SELECT 'weight', 'edge', source || '>' || target FROM be WHERE weight NOT BETWEEN 0 AND 1""")
def q_schema_violations(spark, d):
    return quality.schema_violations(*broken(spark, d))


@query("q_invariants", f"""{T}, {BROKEN_N}, {BROKEN_E} SELECT 'orphan_target' AS rule, 'edge' AS entity, source || '>' || target AS key FROM be WHERE target NOT IN (SELECT id FROM bn) UNION ALL SELECT 'orphan_source', 'edge', source || '>' || target FROM be WHERE source NOT IN (SELECT id FROM bn)
UNION ALL SELECT 'prerequisite_loop', 'edge', source || '>' || target FROM be WHERE source = target AND type = 'PREREQUISITE' UNION ALL SELECT 'duplicate_id', 'node', id FROM bn GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'duplicate_edge', 'edge', source || '>' || target || '>' || type FROM be GROUP BY source, target, type HAVING count(*) > 1""")
def q_invariants(spark, d):
    return quality.invariant_violations(*broken(spark, d))


#: A graph in which every check has something to count: columns made of the nodes' numbers stand in for metrics.
CHECKED = f"""checked AS (SELECT * EXCLUDE (cluster_id), CASE WHEN node_offset = 11 THEN NULL ELSE cluster_id END AS cluster_id, round(pagerank / 2, 6) AS educational_importance, node_offset % 4 AS component_id, node_offset - 3 AS prerequisite_depth, (node_offset % 10) / 8.0 AS bridge_score,
  pagerank AS betweenness_centrality, node_offset % 3 AS degree_in, node_offset % 2 AS degree_out, CASE node_offset WHEN 7 THEN 'NaN'::DOUBLE WHEN 9 THEN NULL ELSE 1.0 END AS learning_effort FROM weighed),
c AS (SELECT count(*)::DOUBLE AS n, sum(pagerank) AS s, sum(educational_importance) AS es, count(DISTINCT component_id) AS comps, min(component_id) AS comp_min, max(component_id) AS comp_max, count(*) FILTER (prerequisite_depth < 0) AS negative,
  count(*) FILTER (isnan(learning_effort)) AS bad, max((learning_effort IS NULL)::INTEGER) + {{absent}} AS absent, count(cluster_id) AS clustered, count(DISTINCT cluster_id) AS clusters,
  count(*) FILTER (bridge_score > 1) AS bridge_out, count(*) FILTER (bridge_score > 0) AS bridge_some, count(*) FILTER (degree_in = 0 AND degree_out = 0) AS orphans FROM checked),
e AS (SELECT count(*) FILTER (_ord % 2 = 1) AS inverse FROM edges), both_ways AS (SELECT count(*) AS k FROM (SELECT DISTINCT a.source, a.target FROM edges a JOIN edges b ON a.source = b.target AND a.target = b.source WHERE a.type = 'PREREQUISITE' AND b.type = 'PREREQUISITE' AND a.source < a.target)),
top AS (SELECT avg(bridge_score) AS v FROM (SELECT bridge_score FROM checked ORDER BY betweenness_centrality DESC, _ord LIMIT 10)), single AS (SELECT count(*) AS k FROM (SELECT cluster_id FROM checked GROUP BY 1 HAVING count(*) = 1)),
dangling AS (SELECT count(*) AS k FROM nodes WHERE type = 'Assessment' AND id NOT IN (SELECT source FROM edges WHERE type = 'TESTS')),
found AS (SELECT 'critical' AS severity, 'pagerank_sum' AS "check", abs(s - 1) <= 0.01 AS ok, s::DOUBLE AS value FROM c UNION ALL SELECT 'critical', 'educational_importance_sum', abs(es - 1) <= 0.01, es FROM c
UNION ALL SELECT 'critical', 'component_id_sequential', comp_min = 0 AND comp_max + 1 = comps, comps FROM c UNION ALL SELECT 'critical', 'prerequisite_depth_positive', negative = 0, negative FROM c
UNION ALL SELECT 'critical', 'nan_inf_values', bad = 0, bad FROM c UNION ALL SELECT 'critical', 'required_metrics', absent = 0, absent FROM c UNION ALL SELECT 'critical', 'inverse_weight', inverse > 0, inverse FROM e
UNION ALL SELECT 'critical', 'prerequisite_cycles', k = 0, k FROM both_ways UNION ALL SELECT 'warning', 'cluster_coverage', clustered = n, clustered FROM c UNION ALL SELECT 'warning', 'modularity', 1 - clusters / n >= 0.1, 1 - clusters / n FROM c
UNION ALL SELECT 'warning', 'bridge_range', bridge_out = 0, bridge_out FROM c UNION ALL SELECT 'warning', 'bridge_some', bridge_some > 0, bridge_some FROM c UNION ALL SELECT 'warning', 'bridge_top', v >= 0.3, v FROM top
UNION ALL SELECT 'warning', 'singleton_clusters', k = 0, k FROM single UNION ALL SELECT 'warning', 'orphan_nodes', orphans = 0, orphans FROM c UNION ALL SELECT 'warning', 'dangling_assessments', k = 0, k FROM dangling)"""
HAVE = {"pagerank", "educational_importance", "component_id", "prerequisite_depth", "bridge_score", "betweenness_centrality", "degree_in", "degree_out", "learning_effort", "cluster_id"}
CHECKED = CHECKED.replace("{absent}", str(len(set(S.NODE_METRICS) - HAVE)))


def checked(g):
    k = F.col("node_offset")
    nodes = weighed(g).withColumns({
        "cluster_id": F.when(k != 11, F.col("cluster_id")), "educational_importance": R(F.col("pagerank") / 2), "component_id": k % 4, "prerequisite_depth": k - 3, "bridge_score": k % 10 / 8.0,
        "betweenness_centrality": F.col("pagerank"), "degree_in": k % 3, "degree_out": k % 2, "learning_effort": F.when(k == 7, F.lit(float("nan"))).when(k == 9, None).otherwise(1.0),
    })
    return quality.checks(nodes, g.edges.withColumn("inverse_weight", F.when(F.col("_ord") % 2 == 1, 1 / F.col("weight"))))


@query("q_checks", f'{T}, {WEIGHED}, {CHECKED} SELECT severity, "check", ok, round(value, 6) AS value FROM found')
def q_checks(spark, d):
    return checked(trade(spark, d)).withColumn("value", R("value"))


@query("q_status", f"""{T}, {WEIGHED}, {CHECKED}, f AS (SELECT count(*) FILTER (NOT ok AND severity = 'critical') AS bad, count(*) FILTER (NOT ok AND severity = 'warning') AS odd FROM found),
s AS (SELECT 'all' AS which, bad, odd FROM f UNION ALL SELECT 'warnings', 0, count(*) FILTER (NOT ok) FROM found WHERE severity = 'warning' UNION ALL SELECT 'sound', 0, 0)
SELECT which, CASE WHEN bad > 0 THEN 'CRITICAL_ISSUES' WHEN odd > 0 THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END AS status, (bad > 0)::INTEGER AS exit_code FROM s""")
def q_status(spark, d):
    found = checked(trade(spark, d))
    parts = {"all": found, "warnings": found.where("severity = 'warning'"), "sound": found.where("ok")}
    out = [quality.status(df).withColumn("which", F.lit(k)) for k, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("q_golden_compare", f"""{T}, {WEIGHED}, c AS (SELECT id, difficulty::DOUBLE AS e, CASE WHEN node_offset % 5 = 0 THEN NULL WHEN node_offset % 3 = 0 THEN difficulty * 1.005 ELSE difficulty * 1.5 END AS a FROM nodes)
SELECT 't' AS graph, id, 'difficulty' AS metric, CASE WHEN a IS NULL THEN 'missing' WHEN abs(a - e) <= 0.01 * abs(e) THEN 'pass' ELSE 'fail' END AS status FROM c""")
def q_golden_compare(spark, d):
    n = nations(spark, d)
    k, v = F.col("node_offset"), F.col("difficulty").cast("double")
    a = n.select(F.lit("t").alias("graph"), "id", F.when(k % 5 == 0, None).when(k % 3 == 0, v * 1.005).otherwise(v * 1.5).alias("difficulty"))
    return quality.compare(a, n.select(F.lit("t").alias("graph"), "id", v.alias("difficulty")), ["difficulty"]).select("graph", "id", "metric", "status")


@query("q_validation_matrix", f"{T}, c AS (SELECT type, node_offset % 3 = 0 AS ok FROM nodes) SELECT type AS graph, round(avg(ok::INTEGER), 6) AS difficulty FROM c GROUP BY 1")
def q_validation_matrix(spark, d):
    n = nations(spark, d)
    v = F.col("difficulty").cast("double")
    a = n.select(F.col("type").alias("graph"), "id", F.when(F.col("node_offset") % 3 == 0, v).otherwise(v * 2).alias("difficulty"))
    m = quality.validation_matrix(quality.compare(a, n.select(F.col("type").alias("graph"), "id", v.alias("difficulty")), ["difficulty"]), ["difficulty"])
    return m.withColumn("difficulty", R("difficulty"))


NEW = "new AS (SELECT row_number() OVER (ORDER BY a.n_nationkey, b.n_nationkey) AS seq, 'n:c:' || a.n_nationkey AS source, 'n:c:' || b.n_nationkey AS target, ['PREREQUISITE','ELABORATES','EXAMPLE_OF'][(a.n_nationkey + b.n_nationkey) % 3 + 1] AS type, ((a.n_nationkey * 7 + b.n_nationkey * 3) % 11) / 10.0::DOUBLE AS weight FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND (a.n_nationkey + b.n_nationkey) % 2 = 0)"


def proposals(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    a, b = (n.select(F.col("n_nationkey").alias(x), F.col("n_regionkey").alias("r")) for x in "ab")
    p = a.join(b, "r").where((F.col("a") + F.col("b")) % 2 == 0)
    kind = F.element_at(F.array(F.lit("PREREQUISITE"), F.lit("ELABORATES"), F.lit("EXAMPLE_OF")), (F.col("a") + F.col("b")) % 3 + 1)
    return p.select((F.col("a") * 25 + F.col("b")).cast("long").alias("seq"), F.concat(F.lit("n:c:"), "a").alias("source"), F.concat(F.lit("n:c:"), "b").alias("target"), kind.alias("type"), (((F.col("a") * 7 + F.col("b") * 3) % 11) / 10.0).alias("weight"))


UPSERT = """j AS (SELECT n.source, n.target, n.type AS nt, n.weight AS nw, e._ord, e.type AS et, e.weight AS ew FROM new n LEFT JOIN edges e ON n.source = e.source AND n.target = e.target)"""


@query("q_upsert", f"""{T}, {NEW}, {UPSERT}, done AS (SELECT source, target, CASE WHEN _ord IS NULL OR (et <> nt AND nw >= ew) THEN nt ELSE et END AS type, CASE WHEN _ord IS NULL OR (et <> nt AND nw >= ew) THEN nw WHEN et = nt THEN greatest(nw, ew) ELSE ew END AS weight FROM j
 UNION ALL SELECT source, target, type, weight FROM edges e WHERE NOT EXISTS (FROM new n WHERE n.source = e.source AND n.target = e.target))
SELECT source, target, type, round(weight, 6) AS weight FROM done WHERE NOT (type = 'PREREQUISITE' AND source = target)""")
def q_upsert(spark, d):
    return refine.upsert(trade(spark, d).edges, proposals(spark, d))[0].select("source", "target", "type", R("weight").alias("weight"))


@query("q_upsert_audit", f"""{T}, {NEW}, {UPSERT}, o AS (SELECT CASE WHEN _ord IS NULL THEN 'added' WHEN et = nt AND nw > ew THEN 'updated' WHEN et <> nt AND nw >= ew THEN 'replaced' ELSE 'kept' END AS op, source, target, nt, et FROM j),
f AS (SELECT source, target, CASE WHEN _ord IS NULL OR (et <> nt AND nw >= ew) THEN nt ELSE et END AS type FROM j)
SELECT op, CASE WHEN op = 'replaced' THEN et || '->' || nt ELSE nt END AS type, count(*) AS n FROM o GROUP BY 1, 2 UNION ALL SELECT 'dropped', 'PREREQUISITE', count(*) FROM f WHERE type = 'PREREQUISITE' AND source = target HAVING count(*) > 0""")
def q_upsert_audit(spark, d):
    return refine.operation_counts(refine.upsert(trade(spark, d).edges, proposals(spark, d))[1])


@query("q_llm_edges", f"""{T}, {NEW}, c AS (SELECT source, target FROM edges), r AS (SELECT source, target, CASE WHEN seq % 5 = 0 THEN NULL ELSE type END AS type, CASE WHEN seq % 3 = 0 THEN weight + 1 ELSE weight END AS weight FROM (SELECT *, CAST(substr(source, 5) AS INTEGER) * 25 + CAST(substr(target, 5) AS INTEGER) AS k FROM new) n(s0, source, target, type, weight, seq))
SELECT r.source, r.target, r.type, round(CASE WHEN weight BETWEEN 0 AND 1 THEN weight ELSE 0.5 END, 6) AS weight FROM r SEMI JOIN c ON r.source = c.source AND r.target = c.target WHERE type IS NOT NULL AND NOT (type = 'PREREQUISITE' AND r.source = r.target)""")
def q_llm_edges(spark, d):
    p = proposals(spark, d)
    kind = F.when(F.col("seq") % 5 == 0, None).otherwise(F.col("type"))
    weight = F.when(F.col("seq") % 3 == 0, F.col("weight") + 1).otherwise(F.col("weight"))
    one = F.struct("source", "target", kind.alias("type"), weight.alias("weight"))
    responses = p.groupBy(F.col("source").alias("source_id")).agg(F.min("seq").alias("seq"), F.to_json(F.collect_list(one)).alias("response"))
    cands = trade(spark, d).edges.select(F.col("source").alias("source_id"), F.col("target").alias("target_id"))
    return refine.model_edges(responses, cands).select("source", "target", "type", R("weight").alias("weight"))


@query("q_split", f"{T}, k AS (SELECT cluster_id FROM nodes GROUP BY 1 HAVING count(*) > 1) SELECT lpad(s.cluster_id::VARCHAR, length((SELECT max(cluster_id) FROM nodes)::VARCHAR)::INTEGER, '0') AS cluster_name, source, target FROM edges JOIN nodes s ON s.id = source JOIN nodes t ON t.id = target WHERE s.cluster_id = t.cluster_id AND s.cluster_id IN (FROM k)")
def q_split(spark, d):
    g = trade(spark, d)
    return enrich.split(g.nodes, g.edges)[1].select("cluster_name", "source", "target")


@query("q_dictionary_stats", f"WITH {CONCEPTS_SQL} SELECT count(*) AS concepts, count(*) AS with_aliases, sum(len(aliases))::BIGINT AS aliases, round(avg(len(aliases)), 2) AS avg_aliases FROM concepts")
def q_dictionary_stats(spark, d):
    from ..operators import build

    return build.dictionary_stats(concepts(spark, d))
