"""The strategies for small and for large graphs follow the same rules; numbering and folds hold at any size."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolex import scratch
from cartolex.operators import build, centrality, enrich, fixpoint, quality, similarity

NODES = "_ord long, id string, difficulty int"
EDGES = "_ord long, source string, target string, type string, weight double"


def graph(spark, ids, links):
    n = spark.createDataFrame([(k, v, k % 5 + 1) for k, v in enumerate(ids)], NODES)
    e = spark.createDataFrame([(k, s, t, "PREREQUISITE", w) for k, (s, t, w) in enumerate(links)], EDGES)
    return n, e


def drawn(n, m, seed, unknown=True):
    rng = random.Random(seed)
    ids = [f"n{k:03d}" for k in range(n)]
    ends = ids + (["ghost", "spook"] if unknown else [])
    pairs = {(rng.choice(ends), rng.choice(ends)) for _ in range(m)}
    return ids, [(s, t, rng.choice([0.25, 0.5, 1.0])) for s, t in sorted(pairs) if s != t]


@pytest.mark.parametrize(("rounds", "tol"), [(3, 1e-6), (100, 1e-6), (2, 1e-12)])
def test_both_pageranks_drop_unknown_ends_and_retry(spark, rounds, tol):
    ids, links = drawn(25, 60, 1)
    n, e = graph(spark, ids, [*links, ("n001", "ghost", 1.0), ("ghost", "n002", 1.0)])
    a, b = ({r["id"]: r["pagerank"] for r in centrality.pagerank(n, e, rounds=rounds, tol=tol, small=s).collect()} for s in (True, False))
    assert a.keys() == b.keys() == set(ids) and all(math.isclose(a[v], b[v], rel_tol=1e-9) for v in ids)
    assert math.isclose(sum(b.values()), 1, rel_tol=1e-9)


def test_pagerank_of_three_nodes_in_three_rounds(spark):
    n, e = graph(spark, ["a", "b", "c"], [("a", "b", 1.0), ("b", "c", 1.0), ("b", "ghost", 1.0)])
    x = dict.fromkeys("abc", 1 / 3)
    for _ in range(3):
        loose = x["c"] / 3
        x = {"a": 0.05 + 0.85 * loose, "b": 0.05 + 0.85 * (x["a"] + loose), "c": 0.05 + 0.85 * (x["b"] + loose)}
    got = {r["id"]: r["pagerank"] for r in centrality.pagerank_rounds(n, e, 3).collect()}
    assert all(math.isclose(got[v], x[v], rel_tol=1e-12) for v in x)


@pytest.mark.parametrize("batch", [10**9, 40])
def test_paths_by_joins_equal_paths_by_search(spark, monkeypatch, batch):
    ids, links = drawn(14, 40, 2, unknown=False)
    n, e = graph(spark, [*ids, "alone"], [*links, (ids[0], ids[1], 0.0)] if (ids[0], ids[1]) not in {x[:2] for x in links} else links)
    monkeypatch.setattr(centrality, "BATCH_ROWS", batch)
    a, b = ({r["id"]: (r["betweenness_centrality"], r["out-closeness"]) for r in centrality.path_metrics(n, e, small=s).collect()} for s in (True, False))
    assert a.keys() == b.keys() and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12) for v in a for x, y in zip(a[v], b[v], strict=True))


def test_betweenness_by_enumeration(spark):
    ids, links = drawn(9, 26, 3, unknown=False)
    links = [(s, t, 1.0) for s, t, _ in links]
    out = {v: [t for s, t, _ in links if s == v] for v in ids}
    want = dict.fromkeys(ids, 0.0)
    for s in ids:
        level, paths = {s: 0}, {s: [[s]]}
        front = [s]
        while front:
            new = {}
            for v in front:
                for w in out[v]:
                    if w not in level:
                        new.setdefault(w, []).extend([*p, w] for p in paths[v])
            for w in new:
                level[w] = 1
            paths |= new
            front = list(new)
        for t, own in paths.items():
            for p in own:
                for v in p[1:-1]:
                    if t != s:
                        want[v] += 1 / len(own)
    n, e = graph(spark, ids, links)
    got = {r["id"]: r["betweenness_centrality"] for r in centrality.path_metrics(n, e).collect()}
    assert all(math.isclose(got[v], want[v] / (8 * 7), rel_tol=1e-9, abs_tol=1e-12) for v in ids)


def test_long_chains_and_rings(spark):
    ring = [f"r{k:04d}" for k in range(1500)]
    links = [(a, b, 1.0) for a, b in zip(ring, ring[1:], strict=False)]
    n, e = graph(spark, ring, links)
    path = [r["id"] for r in enrich.shortest_path(e, ring[0], ring[-1]).orderBy("seq").collect()]
    assert path == ring
    n, e = graph(spark, ring, [*links, (ring[-1], ring[0], 1.0)])
    r = centrality.prerequisite_metrics(n, e).agg(F.max("prerequisite_depth").alias("d"), F.countDistinct("learning_effort").alias("k")).first()
    assert (r["d"], r["k"]) == (0, 1)
    few, hoop = ring[:12], [*zip(ring[:11], ring[1:12], strict=True), (ring[11], ring[0])]
    n, e = graph(spark, [*few, "tail"], [*[(a, b, 1.0) for a, b in hoop], (ring[3], "tail", 1.0)])
    assert {frozenset(x["ids"]) for x in fixpoint.strong_components(n, e).groupBy("scc").agg(F.collect_set("id").alias("ids")).collect()} == {frozenset(few), frozenset(["tail"])}


def test_rows_are_numbered_in_order(spark):
    df = spark.createDataFrame([(k * 7919 % 1000, k) for k in range(1000)], "x long, y long").repartition(7)
    got = scratch.in_order(df, "x").collect()
    assert sorted(r["__n"] for r in got) == list(range(1000)) and all(r["__n"] == r["x"] for r in got)
    assert scratch.in_order(df.limit(0), "x").count() == 0


def answer(k):
    return json.dumps({"concepts_added": {"concepts": [{"concept_id": "c", "term": {"primary": f"p{k}", "aliases": [f"a{k}"]}, "definition": str(k)}]}})


def test_late_slices_fold_in_order(spark, tmp_path):
    from cartolex.streaming import fold

    orders = [1_000_000, 30_000, 2_000_000_000, 21_475]
    df = spark.createDataFrame([(k, f"slice_{k}", answer(k)) for k in orders], fold.RESPONSES)
    r = build.dictionary_from_responses(df).first()
    assert r["definition"] == "21475" and r["term"]["primary"] == "p21475" and set(r["term"]["aliases"]) == {f"a{k}" for k in orders}
    for part, own in enumerate([[30_000, 21_475], [1_000_000], [2_000_000_000]]):
        df.where(F.col("slice_order").isin(own)).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        q = fold.fold_stream(fold.responses_stream(spark, str(tmp_path / "in")), str(tmp_path / "table"), str(tmp_path / "state"))
        q.awaitTermination()
        row = fold.latest(spark, str(tmp_path / "table"), part).first()
    assert row["definition"] == "21475" and set(row["term"]["aliases"]) == {f"a{k}" for k in orders}


def test_terms_of_odd_characters_without_all_pairs(spark):
    chunks = spark.createDataFrame([("a", "Chunk", "use a++b or c++x now"), ("b", "Chunk", "no such"), ("c", "Chunk", "x node.js here, f(x)y")], "id string, type string, text string")
    terms = ["++", "c++", "node.js", "f(x)", "such!"]
    d = spark.createDataFrame([(t, (t, None), "") for t in terms], "concept_id string, term struct<primary: string, aliases: array<string>>, definition string")
    found = build.mentions(chunks, d)
    assert {(r["source"], r["target"]) for r in found.collect()} == {("a", "++"), ("a", "c++"), ("c", "node.js"), ("c", "f(x)")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and found._jdf.queryExecution().executedPlan().toString().find("CartesianProduct") < 0


def test_compare_tells_what_only_one_side_has(spark):
    t = "graph string, id string, m double"
    a = spark.createDataFrame([("g", "x", 1.0), ("g", "y", 2.0)], t)
    b = spark.createDataFrame([("g", "x", 1.0), ("g", "z", 3.0)], t)
    assert {(r["id"], r["status"]) for r in quality.compare(a, b, ["m"]).collect()} == {("x", "pass"), ("y", "unexpected"), ("z", "missing")}


def test_quartiles_by_numbers(spark):
    rng = random.Random(4)
    rows = [(f"n{k}", float(rng.randint(0, 20)), 100.0 if k == 3 else float(k % 7)) for k in range(101)]
    df = spark.createDataFrame(rows, "id string, a double, b double")
    want = set()
    for m, at in (("a", 1), ("b", 2)):
        v = sorted(r[at] for r in rows)
        q1, q3 = v[len(v) // 4], v[3 * len(v) // 4]
        want |= {(m, r[0]) for r in rows if r[at] < q1 - 1.5 * (q3 - q1) or r[at] > q3 + 1.5 * (q3 - q1)}
    assert {(r["metric"], r["id"]) for r in quality.outliers_iqr(df, ["a", "b"]).collect()} == want


@pytest.mark.parametrize("block", [15, 1000])
def test_nearest_is_exact_and_visits_few_cells(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    x = np.concatenate([centres[k % 12] * 3 + rng.normal(size=8) * 0.1 for k in range(150)]).reshape(150, 8)
    x[140:] = x[0]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, vec array<double>")
    sims = np.round(x @ x.T, 12)
    want = set()
    for i in range(150):
        order = sorted((j for j in range(150) if j != i), key=lambda j: (-sims[i, j], j))[:4]
        want |= {(i, j) for j in order}
    assert {(r["i"], r["j"]) for r in similarity.nearest(df, 4, block).collect()} == want
    assert similarity.nearest(df.limit(0), 4).collect() == []
