"""Easiest paths and their summaries, lists by depth, cluster statistics, usage, truncation, answer chains."""

import itertools
import random

import pytest

from cartolex.functions import boundaries
from cartolex.operators import enrich, quality, refine
from cartolex.sources import external, files

NODES = "_ord long, id string, difficulty int"
EDGES = "_ord long, source string, target string, type string, weight double"


def graph(spark, n, edges, difficulty):
    nodes = spark.createDataFrame([(k, f"v{k}", difficulty[k]) for k in range(n)], NODES)
    return nodes, spark.createDataFrame([(k, f"v{s}", f"v{t}", "PREREQUISITE", w) for k, (s, t, w) in enumerate(edges)], EDGES)


def test_easiest_path_is_the_best_of_all_simple_paths(spark):
    rng = random.Random(7)  # a graph in which the start has edges
    n = 6
    difficulty = [1, 5, None, 0, 2, 4]
    edges = [(s, t, rng.choice([0.0, 0.3, 0.9, None])) for s, t in itertools.permutations(range(n), 2) if rng.random() < 0.5 and (s, t) != (0, 5)]
    cost = {(s, t): (difficulty[t] or 3) + 0.5 * (1 - (w or 1.0)) for s, t, w in edges}
    best = None
    for k in range(n - 1):
        for mid in itertools.permutations(range(1, 5), k):
            steps = list(itertools.pairwise((0, *mid, 5)))
            if all(x in cost for x in steps):
                here = (round(sum(cost[x] for x in steps), 9), len(steps))
                best = here if best is None else min(best, here)
    nodes, links = graph(spark, n, edges, difficulty)
    path = enrich.easiest_path(nodes, links, "v0", "v5").orderBy("seq").collect()
    assert (round(path[-1]["cost"], 9), len(path) - 1) == best
    assert [r["seq"] for r in path] == list(range(len(path))) and path[0]["id"] == "v0" and path[-1]["id"] == "v5"
    walked = [int(r["id"][1:]) for r in path]
    assert sum(cost[x] for x in itertools.pairwise(walked)) == pytest.approx(best[0])
    summary = enrich.path_summary(enrich.easiest_path(nodes, links, "v0", "v5"), nodes).first()
    assert (summary["steps"], summary["difficulty"]) == (len(path) - 1, sum(difficulty[v] or 3 for v in walked[1:]))


def test_paths_that_do_not_exist(spark):
    nodes, links = graph(spark, 3, [(0, 1, 1.0)], [1, 1, 1])
    none = enrich.easiest_path(nodes, links, "v0", "v2")
    assert none.collect() == []
    assert tuple(enrich.path_summary(none, nodes).first()) == (None, None)
    assert tuple(enrich.path_summary(enrich.easiest_path(nodes, links, "v0", "v0"), nodes).first()) == (0, 0)


def test_nodes_by_depth_lists_each_depth_in_order(spark):
    rows = [(k, f"v{k}", None if k % 4 == 0 else k % 3) for k in range(40)]
    got = quality.nodes_by_depth(spark.createDataFrame(rows, "_ord long, id string, prerequisite_depth int").repartition(7)).collect()
    want = {}
    for _, v, d in rows:
        want.setdefault(d or 0, []).append(v)
    lists = {d: [r["id"] for r in sorted((r for r in got if r["prerequisite_depth"] == d), key=lambda r: r["place"])] for d in want}
    assert lists == want and len(got) == 40
    assert quality.nodes_by_depth(spark.createDataFrame([], "_ord long, id string, prerequisite_depth int")).collect() == []


def test_cluster_statistics_leave_out_nodes_without_a_cluster(spark):
    n = spark.createDataFrame([("a", 1, 0.9), ("b", 1, 0.7), ("c", 2, None), ("d", None, 0.8)], "id string, cluster_id int, bridge_score double")
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "b"), ("a", "d"), ("d", "c"), ("a", "x")], "source string, target string")
    assert quality.cluster_statistics(n, e).first().asDict() == {"clusters": 2, "bridge_nodes": 2, "inter_cluster_edges": 2}
    assert [r[0] for r in quality.distinct_clusters(n).collect()] == [1, 2]


def test_usage_totals(spark):
    calls = spark.createDataFrame([("x", 2_000_000_000, 1), ("x", 2_000_000_000, None), ("y", 0, 5), (None, None, None)], "stage string, input_tokens int, output_tokens int")
    got = {r["stage"]: tuple(r)[1:] for r in refine.usage_totals(calls).collect()}
    assert got == {"x": (2, 4_000_000_000, 1), "y": (1, 0, 5), None: (1, 0, 0)}


def test_truncated_keeps_whole_tokens():
    text = "Hello, wonderful world 123! " * 40
    tokens = boundaries.Tokens(text)
    for n in (1, 7, len(tokens) - 1):
        cut = boundaries.truncated(text, n)
        assert text.startswith(cut) and len(boundaries.Tokens(cut)) == n
    assert boundaries.truncated(text, len(tokens)) == text
    assert len(boundaries.Tokens(boundaries.truncated(text, 50, 40))) == 40
    assert boundaries.truncated("", 0) == ""
    assert boundaries.truncated("abc", 0) == ""


def test_embeddings_cut_long_texts(spark):
    seen = []
    limits = external.Limits(text_tokens=10, text_kept=4)
    nodes = spark.createDataFrame([("a", "one two three"), ("b", "w " * 30), ("c", None), ("d", "  ")], "id string, text string")

    def embed(texts):
        return [[float(len(t)), 0.0] for t in texts] if all(len(boundaries.Tokens(t)) <= 10 for t in texts) else seen[0]

    got = {r["id"]: list(r["vec"]) for r in external.embeddings(nodes, embed, 2, limits).collect()}
    assert got == {"a": [1.0, 0.0], "b": [1.0, 0.0], "c": [0.0, 0.0], "d": [0.0, 0.0]}


def test_chain_builds_on_confirmed_answers_and_drops_the_oldest():
    gone, asked = [], []

    def drop(x):
        gone.append(x)
        if x == "r1":
            raise RuntimeError("already gone")

    chain, number = external.Chain(2, drop), itertools.count(1)

    def call(previous, hint=""):
        asked.append((previous, hint))
        k = next(number)
        return f"text {k}", f"r{k}"

    chain.confirm()  # nothing to confirm
    assert chain.ask(call) == "text 1"
    chain.confirm()
    assert chain.ask_valid(call, lambda t: t == "text 3", "shorter") == "text 3"
    assert asked == [(None, ""), ("r1", ""), ("r1", "shorter")]  # the repair builds on what was confirmed
    for _ in range(2):
        chain.ask(call)
        chain.confirm()
    assert gone == ["r1", "r3"] and list(chain.kept) == ["r4", "r5"]
    assert chain.ask_valid(call, lambda t: False, "again", repairs=2) is None and chain.previous == "r5"
    alone = external.Chain(0)
    alone.ask(call)
    alone.confirm()
    alone.ask(call)
    assert asked[-1] == (None, "") and not alone.kept


def test_dictionary_with_its_statistics(spark, tmp_path):
    concepts = spark.createDataFrame([("d:p:a", ("a", ["b"]), "x")], "concept_id string, term struct<primary:string,aliases:array<string>>, definition string")
    path = str(tmp_path / "dictionary")
    files.write_dictionary(concepts, path, concepts.groupBy().count())
    assert spark.read.parquet(path).count() == 1 and spark.read.json(path + "_meta").first()["count"] == 1
