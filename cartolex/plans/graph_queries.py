"""Graph algorithms on the trade, purchase and dialogue graphs (see fixtures)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..graph import PropertyGraph, collapse_edges
from ..operators import centrality, enrich, fixpoint, quality, similarity
from .fixtures import DIALOGUE_SQL, PURCHASES_SQL, TRADE_SQL, dialogue, purchases, table, trade
from .registry import query

T, P, V = f"WITH RECURSIVE {TRADE_SQL}", f"WITH RECURSIVE {PURCHASES_SQL}", f"WITH RECURSIVE {DIALOGUE_SQL}"
R = lambda c, n=6: F.round(c, n)

RANKS = """, n AS (SELECT count(*)::DOUBLE AS n FROM nodes), o AS (SELECT source, sum(weight) AS total FROM used GROUP BY 1), sh AS (SELECT u.source, u.target, weight / total AS share FROM used u JOIN o USING (source)),
pr AS (SELECT 0 AS k, id, 1.0::DOUBLE / n AS x FROM nodes, n UNION ALL
 SELECT k + 1, id, 0.15 / n + 0.85 * (got + loose / n) FROM (SELECT pr.k, nodes.id, n.n,
   coalesce((SELECT sum(0.0) FROM nodes WHERE false), 0) AS z, sum(CASE WHEN sh.target = nodes.id THEN pr.x * sh.share ELSE 0 END) AS got,
   sum(CASE WHEN sh.source IS NULL THEN pr.x ELSE 0 END) AS loose FROM pr LEFT JOIN sh ON sh.source = pr.id CROSS JOIN nodes CROSS JOIN n WHERE pr.k < 20 GROUP BY pr.k, nodes.id, n.n))
SELECT id, round(x, 6) AS {name} FROM pr WHERE k = 20"""


@query("q_pagerank_k", f"{T}, used AS (SELECT * FROM edges)" + RANKS.replace("{name}", "pagerank"))
def q_pagerank_k(spark, d):
    g = trade(spark, d)
    return centrality.pagerank_rounds(g.nodes, g.collapsed(), 20).withColumn("pagerank", R("pagerank"))


@query("q_edu_pagerank_k", f"{T}, used AS (SELECT * FROM edges WHERE type IN ({', '.join(f"'{x}'" for x in S.EDUCATIONAL)}))" + RANKS.replace("{name}", "educational_importance"))
def q_edu_pagerank_k(spark, d):
    g = trade(spark, d)
    r = centrality.pagerank_rounds(g.nodes, centrality.educational(g.collapsed()), 20)
    return r.select("id", R("pagerank").alias("educational_importance"))


@query("q_pagerank")
def q_pagerank(spark, d):
    g = purchases(spark, d)
    return centrality.pagerank(g.nodes, g.collapsed())


ALL_RANKS = f"{T}, used AS (SELECT * FROM edges)" + RANKS.replace("{name}", "x")
EDU_RANKS = f"{T}, used AS (SELECT * FROM edges WHERE type IN ({', '.join(f"'{x}'" for x in S.EDUCATIONAL)}))" + RANKS.replace("{name}", "x")


@query("q_pagerank_sum", f"SELECT abs(a - 1) <= 0.01 AS pagerank_ok, abs(b - 1) <= 0.01 AS educational_ok, round(a, 4) AS pagerank_sum, round(b, 4) AS educational_sum FROM (SELECT sum(x) AS a FROM ({ALL_RANKS})), (SELECT sum(x) AS b FROM ({EDU_RANKS}))")
def q_pagerank_sum(spark, d):
    g = trade(spark, d)
    total = lambda r, name, ok: r.agg(F.sum(name).alias("s")).select((F.abs(F.col("s") - 1) <= 0.01).alias(ok), R("s", 4).alias(name.replace("importance", "sum") if name != "pagerank" else "pagerank_sum"))
    a = total(centrality.pagerank(g.nodes, g.collapsed()), "pagerank", "pagerank_ok")
    return a.crossJoin(total(centrality.educational_importance(g.nodes, g.collapsed()), "educational_importance", "educational_ok"))  # one row each


#: Least labels of neighbours, for more rounds than the graph's paths are long.
REACH = """, l AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges UNION SELECT id, id FROM nodes),
r AS (SELECT 0 AS k, id, _ord AS f FROM nodes UNION ALL SELECT r.k + 1, l.b, min(r.f) FROM r JOIN l ON l.a = r.id WHERE r.k < 24 GROUP BY r.k, l.b), c AS (SELECT id, f FROM r WHERE k = 24)"""


@query("q_components", f"{P}{REACH} SELECT id, (dense_rank() OVER (ORDER BY f) - 1)::INTEGER AS component_id FROM c")
def q_components(spark, d):
    g = purchases(spark, d)
    return fixpoint.component_ids(g.nodes, g.edges)


@query("q_component_sizes", f"{P}{REACH} SELECT size, count(*) AS n FROM (SELECT f, count(*) AS size FROM c GROUP BY 1) GROUP BY 1")
def q_component_sizes(spark, d):
    g = purchases(spark, d)
    sizes = fixpoint.connected_components(g.nodes, g.edges).groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


DEPTH = """, w AS (SELECT id, difficulty::DOUBLE AS effort, 0 AS depth FROM nodes UNION SELECT e.target, w.effort + n.difficulty, w.depth + 1 FROM w JOIN edges e ON e.source = w.id JOIN nodes n ON n.id = e.target)"""


@query("q_depth", f"{V}{DEPTH} SELECT id, max(depth)::INTEGER AS prerequisite_depth FROM w GROUP BY 1")
def q_depth(spark, d):
    g = dialogue(spark, d)
    return centrality.prerequisite_metrics(g.nodes, g.collapsed()).select("id", "prerequisite_depth")


@query("q_effort", f"{V}{DEPTH} SELECT id, max(effort) AS learning_effort FROM w GROUP BY 1")
def q_effort(spark, d):
    g = dialogue(spark, d)
    return centrality.prerequisite_metrics(g.nodes, g.collapsed()).select("id", "learning_effort")


@query("q_depth_groups", f"{V}{DEPTH}, m AS (SELECT id, max(depth) AS k FROM w GROUP BY 1) SELECT k::INTEGER AS prerequisite_depth, count(*) AS n FROM m GROUP BY 1")
def q_depth_groups(spark, d):
    g = dialogue(spark, d)
    return centrality.prerequisite_metrics(g.nodes, g.collapsed()).groupBy("prerequisite_depth").agg(F.count(F.lit(1)).alias("n"))


@query("q_nodes_by_depth", f"{V}{DEPTH}, m AS (SELECT id, max(depth)::INTEGER AS k FROM w GROUP BY 1) SELECT k AS prerequisite_depth, row_number() OVER (PARTITION BY k ORDER BY _ord) AS place, id FROM m JOIN nodes USING (id)")
def q_nodes_by_depth(spark, d):
    g = dialogue(spark, d)
    depth = centrality.prerequisite_metrics(g.nodes, g.collapsed()).select("id", "prerequisite_depth")
    return quality.nodes_by_depth(g.nodes.join(depth, "id"))


HOPS = """, w AS (SELECT '{start}' AS id, 0 AS hops UNION SELECT e.target, hops + 1 FROM w JOIN used e ON e.source = w.id WHERE hops < 12), h AS (SELECT id, min(hops)::INTEGER AS hops FROM w GROUP BY 1)"""


#: The types of the first tier alone leave paths of several steps.
STRONG = f"used AS (SELECT * FROM edges WHERE type IN ({', '.join(f"'{x}'" for x in S.STRONG)}))"


def strong(g):
    return g.edges.where(F.col("type").isin(*S.STRONG))


@query("q_bfs", f"{T}, {STRONG}{HOPS.replace('{start}', 'n:c:8')} SELECT id, hops FROM h")
def q_bfs(spark, d):
    g = trade(spark, d)
    return fixpoint.breadth_first(strong(g), g.nodes.where("id = 'n:c:8'")).select("id", "hops")


@query("q_ancestors", f"{T}, used AS (SELECT target AS source, source AS target FROM edges WHERE type IN ('PREREQUISITE', 'ELABORATES', 'EXAMPLE_OF')){HOPS.replace('{start}', 'n:c:3')} SELECT id, hops FROM h WHERE hops > 0")
def q_ancestors(spark, d):
    return enrich.ancestors(trade(spark, d).edges, "n:c:3")


BACK = """b AS (SELECT 'n:c:15' AS id, (SELECT hops FROM h WHERE id = 'n:c:15') AS seq UNION ALL SELECT (SELECT min(e.source) FROM used e JOIN h ON h.id = e.source WHERE e.target = b.id AND h.hops = b.seq - 1), seq - 1 FROM b WHERE seq > 0)"""


@query("q_shortest_path", f"{T}, {STRONG}{HOPS.replace('{start}', 'n:c:8')}, {BACK} SELECT seq::INTEGER AS seq, id FROM b WHERE seq IS NOT NULL")
def q_shortest_path(spark, d):
    return enrich.shortest_path(strong(trade(spark, d)), "n:c:8", "n:c:15")


@query("q_path_summary", f"{T}, {STRONG}{HOPS.replace('{start}', 'n:c:8')}, {BACK} SELECT max(seq)::BIGINT AS steps, sum(CASE WHEN seq > 0 THEN difficulty WHEN seq = 0 THEN 0 END)::BIGINT AS difficulty FROM b JOIN nodes USING (id)")
def q_path_summary(spark, d):
    g = trade(spark, d)
    return enrich.path_summary(enrich.shortest_path(strong(g), "n:c:8", "n:c:15"), g.nodes)


@query("q_ladder")
def q_ladder(spark, d):
    return enrich.ladder_path(trade(spark, d).edges, "n:c:0", "n:c:1")


@query("q_easiest_path", f"""{T}, k AS (SELECT source, target, n.difficulty + 0.5 * (1 - weight) AS cost FROM edges JOIN nodes n ON n.id = target),
w AS (SELECT 'n:c:0' AS id, 0.0::DOUBLE AS cost, 0 AS hops UNION ALL SELECT id, min(cost), min(hops) FROM (SELECT k.target AS id, w.cost + k.cost AS cost, hops + 1 AS hops FROM w JOIN k ON k.source = w.id WHERE hops < 24) GROUP BY id)
SELECT id, round(min(cost), 6) AS cost FROM w GROUP BY 1""")
def q_easiest_path(spark, d):
    g = trade(spark, d)
    return enrich.least_costs(enrich.path_costs(g.nodes, g.collapsed()), "n:c:0").select("id", R("cost").alias("cost"))


@query("q_easiest_route", f"""{T}, k AS (SELECT source, target, n.difficulty + 0.5 * (1 - weight) AS cost FROM edges JOIN nodes n ON n.id = target WHERE edges.type IN ({', '.join(f"'{x}'" for x in S.STRONG)})),
c AS (SELECT 'n:c:8' AS id, 0.0::DOUBLE AS cost, 0 AS hops UNION ALL SELECT id, min(cost), min(hops) FROM (SELECT k.target AS id, c.cost + k.cost AS cost, hops + 1 AS hops FROM c JOIN k ON k.source = c.id WHERE hops < 24) GROUP BY id),
m AS (SELECT id, min(cost) AS cost FROM c GROUP BY 1), used AS (SELECT source, target FROM k JOIN m s ON s.id = source JOIN m t ON t.id = target WHERE abs(s.cost + k.cost - t.cost) < 1e-9)
{HOPS.replace('{start}', 'n:c:8')}, {BACK} SELECT seq::INTEGER AS seq, b.id, round(m.cost, 6) AS cost FROM b JOIN m USING (id) WHERE seq IS NOT NULL""")
def q_easiest_route(spark, d):
    g = trade(spark, d)
    return enrich.easiest_path(g.nodes, strong(g), "n:c:8", "n:c:15").withColumn("cost", R("cost"))


CLOSE = """, k AS (SELECT source, target, 1.0 / weight AS cost FROM edges), w AS (SELECT id AS start, id, 0.0::DOUBLE AS cost, 0 AS hops FROM nodes UNION ALL
 SELECT start, id, min(cost), min(hops) FROM (SELECT w.start, k.target AS id, w.cost + k.cost AS cost, hops + 1 AS hops FROM w JOIN k ON k.source = w.id WHERE hops < 24) GROUP BY start, id), m AS (SELECT start, id, min(cost) AS cost FROM w GROUP BY 1, 2)"""


@query("q_closeness", f"{T}{CLOSE} SELECT start AS id, round(CASE WHEN sum(cost) > 0 THEN (count(*) - 1) / sum(cost) * (count(*) - 1) / ((SELECT count(*) FROM nodes) - 1) ELSE 0 END, 6) AS out_closeness FROM m GROUP BY 1")
def q_closeness(spark, d):
    g = trade(spark, d)
    return centrality.path_metrics(g.nodes, g.collapsed()).select("id", R("`out-closeness`").alias("out_closeness"))


@query("q_betweenness")
def q_betweenness(spark, d):
    g = trade(spark, d)
    return centrality.path_metrics(g.nodes, g.collapsed()).select("id", R("betweenness_centrality").alias("betweenness_centrality"))


@query("q_louvain")
def q_louvain(spark, d):
    g = trade(spark, d)
    return centrality.louvain(g.nodes, g.collapsed())


@query("q_bridge_score")
def q_bridge_score(spark, d):
    g = trade(spark, d)
    e = g.collapsed()
    return centrality.bridge_scores(g.nodes, e, centrality.louvain(g.nodes, e), centrality.path_metrics(g.nodes, e)).withColumn("bridge_score", R("bridge_score"))


@query("q_all_metrics")
def q_all_metrics(spark, d):
    return centrality.all_metrics(trade(spark, d)).nodes


@query("q_all_edge_metrics")
def q_all_edge_metrics(spark, d):
    return centrality.all_metrics(trade(spark, d)).edges


@query("q_demo_path_optimal")
def q_demo_path_optimal(spark, d):
    return enrich.demo_path(centrality.all_metrics(trade(spark, d)), 1)


@query("q_demo_path_critical")
def q_demo_path_critical(spark, d):
    return enrich.demo_path(centrality.all_metrics(trade(spark, d)), 3)


@query("q_cycles", f"{T}, used AS (SELECT source, target FROM edges WHERE type IN ('PREREQUISITE', 'ELABORATES', 'PARALLEL')), r AS (SELECT source AS a, target AS b FROM used WHERE source <> target UNION SELECT r.a, u.target FROM r JOIN used u ON u.source = r.b) SELECT n.id, coalesce((SELECT min(x.b) FROM r x JOIN r y ON x.a = n.id AND y.a = x.b AND y.b = n.id), n.id) AS scc FROM nodes n")
def q_cycles(spark, d):
    g = trade(spark, d)
    scc = fixpoint.strong_components(g.nodes, g.edges.where("type IN ('PREREQUISITE', 'ELABORATES', 'PARALLEL')"))
    least = scc.groupBy("scc").agg(F.min("id").alias("least"))
    return scc.join(least, "scc").select("id", F.col("least").alias("scc"))


VECTORS = """vec AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS v, 'e:c:' || vec_id AS id FROM embeddings),
sims AS (SELECT a.i, b.i AS j, round(list_dot_product(a.v, b.v), 12) AS s FROM vec a JOIN vec b ON a.i <> b.i), near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS r FROM sims) WHERE r <= 5)"""


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.concat(F.lit("e:c:"), "vec_id").alias("id"), F.repeat(F.lit("x"), (F.col("vec_id") % 7 + 3).cast("int")).alias("text"), F.col("embedding").alias("vec"))


@query("q_knn", f"WITH {VECTORS} SELECT i, j, round(s, 6) AS similarity FROM near")
def q_knn(spark, d):
    own = similarity.numbered(vectors(spark, d))
    return similarity.nearest(own.select("i", "vec"), 5).withColumn("similarity", R("similarity"))


PAIRS = "pairs AS (SELECT a.id AS master_id, b.id AS duplicate_id, s FROM near JOIN vec a ON a.i = near.i JOIN vec b ON b.i = near.j WHERE s >= 0.3 AND near.j > near.i AND least(a.vec_id % 7 + 3, b.vec_id % 7 + 3) / greatest(a.vec_id % 7 + 3, b.vec_id % 7 + 3) >= 0.5)"


@query("q_dup_pairs", f"WITH {VECTORS}, {PAIRS} SELECT master_id, duplicate_id, round(s, 6) AS similarity FROM pairs")
def q_dup_pairs(spark, d):
    return similarity.duplicate_pairs(vectors(spark, d), 5, 0.3, 0.5).withColumn("similarity", R("similarity"))


MASTERS = """l AS (SELECT master_id AS a, duplicate_id AS b FROM pairs UNION SELECT duplicate_id, master_id FROM pairs), r AS (SELECT a AS id, a AS other FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other),
m AS (SELECT r.id, min(other) FILTER (other NOT IN (SELECT duplicate_id FROM pairs)) AS master_id FROM r GROUP BY 1)"""


@query("q_dup_master", f"WITH RECURSIVE {VECTORS}, {PAIRS}, {MASTERS} SELECT id AS duplicate_id, master_id FROM m WHERE id <> master_id")
def q_dup_master(spark, d):
    return similarity.duplicate_map(similarity.duplicate_pairs(vectors(spark, d), 5, 0.3, 0.5))


@query("q_dup_map_csv", f"WITH RECURSIVE {VECTORS}, {PAIRS}, {MASTERS}, pq AS (SELECT master_id, duplicate_id, s FROM pairs UNION ALL SELECT duplicate_id, master_id, s FROM pairs) SELECT id AS duplicate_id, m.master_id, printf('%.4f', coalesce(max(s), 0.0)) AS similarity FROM m LEFT JOIN pq b ON b.master_id = m.master_id AND b.duplicate_id = m.id WHERE id <> m.master_id GROUP BY 1, 2")
def q_dup_map_csv(spark, d):
    pairs = similarity.duplicate_pairs(vectors(spark, d), 5, 0.3, 0.5)
    return similarity.map_with_similarity(similarity.duplicate_map(pairs), pairs)


CANDIDATES = f"WITH {VECTORS} SELECT a.id AS source_id, b.id AS target_id, round(s, 6) AS similarity, CASE WHEN (a.vec_id + b.vec_id) % 2 = 0 THEN 1 ELSE 0 END AS existing FROM near JOIN vec a ON a.i = near.i JOIN vec b ON b.i = near.j WHERE s >= 0.3 AND b.vec_id {{op}} a.vec_id"


def candidates(spark, d, forward):
    v = similarity.numbered(vectors(spark, d))
    pairs = similarity.nearest(v.select("i", "vec"), 5)
    n = v.select("i", "id", "position")
    a, b = n.withColumnsRenamed({"id": "source", "position": "p"}), n.withColumnsRenamed({"i": "j", "id": "target", "position": "q"})
    # An edge in one direction between each pair of neighbours whose ids add up to an even number.
    e = pairs.join(a, "i").join(b, "j").where("(p + q) % 2 = 0").select(F.least("source", "target").alias("source"), F.greatest("source", "target").alias("target")).distinct()
    e = e.select(F.xxhash64("source", "target").alias("_ord"), "source", "target", F.lit("PARALLEL").alias("type"), F.lit(0.5).alias("weight"))
    return similarity.candidates(v, e, 5, 0.3, forward, pairs).select("source_id", "target_id", R("similarity").alias("similarity"), F.size("existing_edges").alias("existing"))


@query("q_candidates_fwd", CANDIDATES.format(op=">"))
def q_candidates_fwd(spark, d):
    return candidates(spark, d, True)


@query("q_candidates_bwd", CANDIDATES.format(op="<"))
def q_candidates_bwd(spark, d):
    return candidates(spark, d, False)


@query("q_purchase_degree", f"{P} SELECT n.id, (SELECT count(*) FROM edges e WHERE e.target = n.id)::INTEGER AS degree_in, (SELECT count(*) FROM edges e WHERE e.source = n.id)::INTEGER AS degree_out FROM nodes n")
def q_purchase_degree(spark, d):
    g = purchases(spark, d)
    return centrality.degrees(g.nodes, collapse_edges(g.edges)).select("id", "degree_in", "degree_out")


@query("q_path_costs", f"{T} SELECT source, target, round(n.difficulty + 0.5 * (1 - weight), 6) AS cost, round(1.0 / weight, 6) AS length FROM edges JOIN nodes n ON n.id = target")
def q_path_costs(spark, d):
    g = trade(spark, d)
    return enrich.path_costs(g.nodes, g.edges).select("source", "target", R("cost").alias("cost"), R(C.inverse_weight(F.col("weight"))).alias("length"))
