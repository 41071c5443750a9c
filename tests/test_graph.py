import math

import pytest
from pyspark.sql import functions as F

from cartolex import schema as S
from cartolex.graph import PropertyGraph, collapse_edges
from cartolex.operators import centrality, enrich, fixpoint, quality, refine, relational, similarity

from .golden import GRAPHS, parsed

METRICS = list(S.NODE_METRICS)


@pytest.mark.parametrize("name", sorted(GRAPHS))
def test_golden(spark, name):
    nodes, edges, expected = parsed(name)
    out = centrality.all_metrics(PropertyGraph.of(spark, nodes, edges))
    rows = {r["id"]: r for r in out.nodes.collect()}
    assert rows.keys() == expected.keys()
    for v, want in expected.items():
        for m, x in zip(METRICS, want, strict=True):
            assert math.isclose(rows[v][m], x, rel_tol=0.01, abs_tol=0.001), (v, m, rows[v][m], x)
    for r in out.edges.collect():
        assert math.isclose(r["inverse_weight"], 1 / r["weight"])


def test_loops_agree_with_kernels(spark):
    n, e, _ = parsed("realistic")
    g = PropertyGraph.of(spark, n, e)
    c = g.collapsed()
    a, b = ({r["id"]: r["pagerank"] for r in centrality.pagerank(g.nodes, c, small=s, rounds=300).collect()} for s in (True, False))
    assert all(math.isclose(a[v], b[v], abs_tol=1e-6) for v in a)
    for name in ("realistic", "cycle", "bridge"):
        n, e, _ = parsed(name)
        g = PropertyGraph.of(spark, n, e)
        x, y = ({tuple(r) for r in centrality.prerequisite_metrics(g.nodes, g.collapsed(), small=s).select("id", "prerequisite_depth", "learning_effort").collect()} for s in (True, False))
        assert x == y


def cliques(k, size, links):
    e = [(f"n{c}{i}", f"n{c}{j}", "PARALLEL", 1.0) for c in range(k) for i in range(size) for j in range(size) if i < j]
    return [(f"n{c}{i}", "Chunk", 3) for c in range(k) for i in range(size)], e + links


def test_three_cliques_make_three_clusters(spark):
    n, e = cliques(3, 5, [("n00", "n10", "PARALLEL", 0.1), ("n11", "n20", "PARALLEL", 0.1)])
    g = PropertyGraph.of(spark, n, e)
    got = {r["id"]: r["cluster_id"] for r in centrality.louvain(g.nodes, g.collapsed()).collect()}
    assert {v: k for v, k in got.items()} == {f"n{c}{i}": c for c in range(3) for i in range(5)}
    assert got == {r["id"]: r["cluster_id"] for r in centrality.louvain(g.nodes, g.collapsed()).collect()}


def test_barbell_bridge_scores_highest(spark):
    n, e = cliques(2, 5, [("n00", "x", "PARALLEL", 1.0), ("x", "n10", "PARALLEL", 1.0), ("n10", "x", "PARALLEL", 1.0), ("x", "n00", "PARALLEL", 1.0)])
    e += [(t, s, k, w) for s, t, k, w in e]
    g = PropertyGraph.of(spark, [*n, ("x", "Chunk", 3)], e)
    out = {r["id"]: r["bridge_score"] for r in centrality.all_metrics(g).nodes.collect()}
    assert sorted(out, key=out.get)[-3:] and "x" in sorted(out, key=out.get)[-3:]


def test_components_and_isolated_nodes(spark):
    n = [(c, "Chunk", 1) for c in "abcdefgh"]
    e = [("b", "a", "X", 1.0), ("b", "c", "X", 1.0), ("h", "g", "X", 1.0), ("d", "d", "X", 1.0)]
    g = PropertyGraph.of(spark, n, e)
    loop = {r["id"]: r["root"] for r in fixpoint.connected_components(g.nodes, g.edges, small=False).collect()}
    assert loop == {r["id"]: r["root"] for r in fixpoint.connected_components(g.nodes, g.edges).collect()}
    start = g.nodes.where("id = 'b'")
    assert set(fixpoint.breadth_first(g.edges, start, small=False).collect()) == set(fixpoint.breadth_first(g.edges, start).collect())
    assert {r["id"]: r["component_id"] for r in fixpoint.component_ids(g.nodes, g.edges).collect()} == {"a": 0, "b": 0, "c": 0, "d": 1, "e": 2, "f": 3, "g": 4, "h": 4}


def test_long_chain_is_one_component(spark):
    n = [(f"v{i:03d}", "Chunk", 1) for i in range(100)]
    e = [(f"v{i:03d}", f"v{i + 1:03d}", "X", 1.0) for i in range(99)]
    g = PropertyGraph.of(spark, n, e)
    assert {r["root"] for r in fixpoint.connected_components(g.nodes, g.edges, small=False).collect()} == {"v000"}


def test_empty_and_single(spark):
    g = PropertyGraph.of(spark, [("a", "Chunk", 2)], [])
    r = centrality.all_metrics(g).nodes.first()
    assert (r["degree_centrality"], r["pagerank"], r["betweenness_centrality"], r["out-closeness"], r["cluster_id"]) == (1.0, 1.0, 0.0, 0.0, 0)
    empty = PropertyGraph.of(spark, [], [])
    assert centrality.degrees(empty.nodes, empty.collapsed()).count() == 0
    assert relational.top_nodes(empty.nodes.withColumn("pagerank", F.lit(0.0)), empty.edges)[1].count() == 0


def test_parallel_edges_collapse_to_the_last(spark):
    g = PropertyGraph.of(spark, [("a", "Chunk", 1), ("b", "Chunk", 1)], [("a", "b", "TESTS", 0.2), ("a", "b", "MENTIONS", None)])
    assert [(r["type"], r["weight"]) for r in collapse_edges(g.edges).collect()] == [("MENTIONS", 1.0)]


def test_zero_weight_has_no_length(spark):
    g = PropertyGraph.of(spark, [(v, "Chunk", 1) for v in "abc"], [("a", "b", "X", 0.0), ("b", "c", "X", 0.5)])
    out = {r["id"]: r["out-closeness"] for r in centrality.path_metrics(g.nodes, g.collapsed()).collect()}
    assert out["a"] == 0.0 and out["b"] > 0


OLD = [("a", "b", "PREREQUISITE", 0.5), ("a", "c", "ELABORATES", 0.4), ("a", "c", "TESTS", 0.6), ("d", "d", "PREREQUISITE", 0.3), ("x", "y", "TESTS", None)]


@pytest.mark.parametrize(
    ("new", "edge", "ops"),
    [
        (("a", "z", "TESTS", 0.7), ("TESTS", 0.7, refine.ADDED), {("added", "TESTS")}),
        (("a", "b", "PREREQUISITE", 0.9), ("PREREQUISITE", 0.9, None), {("updated", "PREREQUISITE")}),
        (("a", "b", "PREREQUISITE", 0.1), ("PREREQUISITE", 0.5, None), {("kept", "PREREQUISITE")}),
        (("a", "c", "MENTIONS", 0.6), ("MENTIONS", 0.6, refine.FIXED), {("replaced", "ELABORATES->MENTIONS"), ("replaced", "TESTS->MENTIONS")}),
        (("a", "b", "TESTS", 0.4), ("PREREQUISITE", 0.5, None), {("kept", "TESTS")}),
        (("x", "y", "MENTIONS", 0.5), ("MENTIONS", 0.5, refine.FIXED), {("replaced", "TESTS->MENTIONS")}),
    ],
)
def test_upsert(spark, new, edge, ops):
    old = PropertyGraph.of(spark, [], OLD).edges.withColumn("conditions", F.lit(None).cast("string"))
    proposals = spark.createDataFrame([(0, *new)], "seq long, source string, target string, type string, weight double")
    out, audit = refine.upsert(old, proposals)
    rows = [(r["type"], r["weight"], r["conditions"]) for r in out.collect() if (r["source"], r["target"]) == new[:2]]
    assert rows == [edge]
    assert {(r["op"], r["type"]) for r in audit.collect()} == ops
    assert not out.where("source = 'd'").count()  # a PREREQUISITE self-loop goes
    again, _ = refine.upsert(out, proposals)
    assert {tuple(r)[1:5] for r in again.collect()} == {tuple(r)[1:5] for r in out.collect()}


def test_dedup_master_is_the_string_minimum(spark):
    pairs = spark.createDataFrame([("s:c:200", "s:c:1000", 0.9), ("s:c:1000", "s:c:3000", 0.9), ("t:c:1", "t:c:2", 0.9)], "master_id string, duplicate_id string, similarity double")
    m = similarity.duplicate_map(pairs)
    assert {tuple(r) for r in m.collect()} == {("s:c:1000", "s:c:200"), ("s:c:3000", "s:c:200"), ("t:c:2", "t:c:1")}
    rows = {r["duplicate_id"]: r["similarity"] for r in similarity.map_with_similarity(m, pairs).collect()}
    assert rows == {"s:c:1000": "0.9000", "s:c:3000": "0.0000", "t:c:2": "0.9000"}


def test_nearest_in_blocks(spark):
    import numpy as np

    x = np.random.default_rng(3).normal(size=(60, 8))
    x[7] = x[3]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i long, vec array<double>")
    got = {(r["i"], r["j"]) for r in similarity.nearest(df, 4, block=13).collect()}
    s = np.round(x @ x.T, 12)
    np.fill_diagonal(s, -np.inf)
    assert got == {(i, int(j)) for i in range(60) for j in np.argsort(-s[i], kind="stable")[:4]}


def test_paths(spark):
    e = [("a", "b", "PREREQUISITE", 0.9), ("b", "c", "ELABORATES", 0.5), ("a", "c", "MENTIONS", 0.1), ("c", "d", "TESTS", 0.0)]
    g = PropertyGraph.of(spark, [(v, "Chunk", i + 1) for i, v in enumerate("abcdz")], e)
    ids = lambda df: [r["id"] for r in df.orderBy("seq").collect()]
    assert ids(enrich.shortest_path(g.edges, "a", "d")) == ["a", "c", "d"]
    assert ids(enrich.ladder_path(g.edges, "a", "d")) == ["a", "b", "c", "d"]
    assert ids(enrich.shortest_path(g.edges, "a", "z")) == []
    cost = {r["id"]: r["cost"] for r in enrich.least_costs(enrich.path_costs(g.nodes, g.edges), "a").collect()}
    assert math.isclose(cost["c"], 3 + 0.45) and math.isclose(cost["d"], cost["c"] + 4)


def test_demo_paths_are_of_the_length_asked_for(spark):
    n, e, _ = parsed("realistic")
    g = centrality.all_metrics(PropertyGraph.of(spark, n, e))
    depth = {r["id"]: r["prerequisite_depth"] for r in g.nodes.collect()}
    for strategy in (1, 2, 3, 9):
        path = [r["id"] for r in enrich.demo_path(g, strategy, 6).orderBy("seq").collect()]
        assert len(path) == len(set(path)) <= 6 and [depth[v] for v in path] == sorted(depth[v] for v in path)


def test_checks_of_a_sound_graph(spark):
    n, e, _ = parsed("realistic")
    g = centrality.all_metrics(PropertyGraph.of(spark, n, e))
    found = {r["check"]: r for r in quality.checks(g.nodes, g.edges).collect()}
    assert all(r["ok"] for r in found.values() if r["severity"] == "critical")
    assert quality.status(quality.checks(g.nodes, g.edges), strict=False).first()["exit_code"] == 0


def test_schema_rules(spark):
    g = PropertyGraph.of(spark, [("a b", "Chunk", 7), (None, "Thing", 1)], [("a", "b", "NONE", 1.5)])
    got = {(r["rule"], r["entity"]) for r in quality.schema_violations(g.nodes.withColumn("text", F.lit(None).cast("string")), g.edges).collect()}
    assert got == {("id_pattern", "node"), ("difficulty", "node"), ("text_missing", "node"), ("id_missing", "node"), ("type", "node"), ("type", "edge"), ("weight", "edge")}


def test_searches_go_on_until_nothing_is_left(spark, monkeypatch):
    edge = "source string, target string"
    way = [f"v{k:04d}" for k in range(2000)]
    line = spark.createDataFrame(list(zip(way, way[1:], strict=False)), edge)
    start = spark.createDataFrame([(way[0],)], "id string")
    assert {r["id"]: r["hops"] for r in fixpoint.breadth_first(line, start).collect()} == {v: k for k, v in enumerate(way)}
    assert fixpoint.breadth_first(line, start, 30).count() == 31
    few = spark.createDataFrame(list(zip(way[:8], way[1:8], strict=False)), edge)
    assert {r["hops"] for r in fixpoint.breadth_first(few, start, small=False).collect()} == set(range(8))
    # The colours of a cycle, which take as many rounds as it has nodes, are given; the search back is under test.
    monkeypatch.setattr(fixpoint, "_spread", lambda labels, links: labels.select("id", F.lit(way[0]).alias("root")))
    nodes = spark.createDataFrame([(v,) for v in way], "id string")
    ring = line.unionByName(spark.createDataFrame([(way[-1], way[0])], edge))
    found = fixpoint.strong_components(nodes, ring).collect()
    assert len(found) == 2000 and {r["scc"] for r in found} == {way[0]}


def test_costs_are_final_or_refused(spark):
    cost = "source string, target string, cost double"
    e = [("a", "b", 5.0), ("a", "c", 1.0), ("c", "d", 1.0), ("d", "b", 1.0), ("b", "e", 1.0)]
    for small in (True, False):
        got = {r["id"]: r["cost"] for r in enrich.least_costs(spark.createDataFrame(e, cost), "a", small).collect()}
        assert got == {"a": 0.0, "c": 1.0, "d": 2.0, "b": 3.0, "e": 4.0}
    with pytest.raises(ValueError, match="negative"):
        enrich.least_costs(spark.createDataFrame([("a", "b", 1.0), ("b", "a", -2.0)], cost), "a", False)
