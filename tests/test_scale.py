"""What a step sends, holds and repeats may not grow faster than its input."""

import random
import re
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from cartolex import scratch
from cartolex.graph import PropertyGraph
from cartolex.operators import build, centrality, enrich, fixpoint, similarity, slicing
from cartolex.plans import fixtures


def shuffled(spark) -> int:
    """Bytes that tasks have written to shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    time.sleep(0.3)
    spark.range(1).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    each = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(each.apply(k).totalShuffleWrite() for k in range(each.size()))


def test_no_text_goes_along_with_its_words(spark):
    rng = random.Random(5)
    texts = [(f"c{k}", "Chunk", " ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(800)) + " tree, c++x") for k in range(8)]
    chunks = spark.createDataFrame(texts, "id string, type string, text string")
    d = spark.createDataFrame([("t", ("Tree", ["trees"]), ""), ("c", ("c++", None), "")], "concept_id string, term struct<primary: string, aliases: array<string>>, definition string")
    before = shuffled(spark)
    found = build.mentions(chunks, d)
    assert {(r["source"], r["target"]) for r in found.collect()} == {(f"c{k}", x) for k in range(8) for x in "tc"}
    assert shuffled(spark) - before < 2 * sum(len(t) for _, _, t in texts)
    nodes = chunks.select("id", "type").union(spark.createDataFrame([("t", "Concept"), ("c", "Concept")], "id string, type string"))
    assert {r["concept_id"]: r["n"] for r in enrich.concept_usage(nodes, found, d).collect()} == {"t": 8, "c": 8}


def test_nearest_sends_each_part_once_for_each_other(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[1::9], x[3] = x[0], 0  # one common vector, and one without a length
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, vec array<float>")
    s = np.round(x.astype(np.float64) @ x.astype(np.float64).T, 12)
    np.fill_diagonal(s, -np.inf)
    want = {(i, int(j)) for i in range(900) for j in np.argsort(-s[i], kind="stable")[:5]}
    before = shuffled(spark)
    got = similarity.nearest(df, 5, 20)
    assert {(r["i"], r["j"]) for r in got.collect()} == want
    # 45 blocks in 8 parts or a few more: not every vector with each block that it may have a neighbour in.
    assert shuffled(spark) - before < 20 * x.nbytes
    once = shuffled(spark)
    got.count(), got.count()
    assert shuffled(spark) - once < 1000  # nothing is done again for each use


def test_nearest_passes_by_what_has_no_product(spark):
    x = np.random.default_rng(9).normal(size=(50, 4))
    x[7, 0], x[9, 1], x[11] = np.nan, np.inf, 1e200
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, vec array<double>")
    with np.errstate(all="ignore"):
        s = np.round(np.einsum("id,jd->ij", x, x), 12)
    s[~np.isfinite(s)] = -np.inf
    np.fill_diagonal(s, -np.inf)
    want = {(i, int(j)) for i in range(50) for j in np.argsort(-s[i], kind="stable")[:3] if s[i, j] > -np.inf}
    assert {(r["i"], r["j"]) for r in similarity.nearest(df, 3, 12).collect()} == want


def test_pairs_are_found_once(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(60, 4)).tolist()
    nodes = spark.createDataFrame([(f"e:c:{k}", "x" * (k % 7 + 3), v) for k, v in enumerate(x)], "id string, text string, vec array<double>")
    calls = []
    found = similarity.nearest
    monkeypatch.setattr(similarity, "nearest", lambda *a: calls.append(a) or found(*a))
    pairs = similarity.duplicate_pairs(nodes, 3, 0.3, 0.5)
    once = shuffled(spark)
    assert pairs.count() and pairs.count() and shuffled(spark) - once < 1000
    own = similarity.numbered(nodes)
    near = found(own.select("i", "vec"), 3)
    edges = spark.createDataFrame([], "_ord long, source string, target string, type string, weight double")
    calls.clear()
    given, alone = (similarity.candidates(n, edges, 3, 0.3, True, o).select("source_id", "target_id") for n, o in ((own, near), (nodes, None)))
    assert len(calls) == 1 and sorted(given.collect()) == sorted(alone.collect())


def test_files_are_cut_once_and_numbered_without_one_window(spark):
    files = spark.createDataFrame([(f"f{k:03d}", "One two. Three four.\n\n" * (k % 5)) for k in range(40)], "source_file string, text string")
    s = slicing.slice_files(files, 8, True, 3)
    rows = s.orderBy("order").collect()
    assert [r["order"] for r in rows] == list(range(1, len(rows) + 1)) and [r["source_file"] for r in rows] == sorted(r["source_file"] for r in rows)
    assert {k: "".join(r["text"] for r in rows if r["source_file"] == f"f{k:03d}") for k in range(40)} == {k: "One two. Three four.\n\n" * (k % 5) for k in range(40)}
    plan = s._jdf.queryExecution().toString()
    assert "MapIn" not in plan and not re.search(r"Window .*windowspecdefinition\(source_file", plan)


def test_sums_before(spark):
    df = spark.createDataFrame([(k, k * 7 % 11) for k in range(200)], "k long, v long").repartition(7)
    got = {r["k"]: r["__n"] for r in scratch.sums_before(df, "v", F.desc("k")).collect()}
    assert got == {k: sum(j * 7 % 11 for j in range(k + 1, 200)) for k in range(200)}


def test_trade_tables_are_joined_once_and_answers_parsed_once(spark):
    edges = fixtures.trade(spark, "/root/testdata/sf0.001").edges
    assert "l_orderkey" not in edges._jdf.queryExecution().optimizedPlan().toString()
    patch = '{"chunk_graph_patch": {"nodes": [{"id": "chunk_1", "type": "Chunk", "text": "a tree", "node_offset": 3}], "edges": []}}'
    responses = spark.createDataFrame([(1, "slice_001", patch)], "slice_order int, slice_id string, response string")
    slices = spark.createDataFrame([("slice_001", "s", 10)], "id string, slug string, slice_token_start int")
    d = spark.createDataFrame([("t", ("Tree", ["trees"]), "")], "concept_id string, term struct<primary: string, aliases: array<string>>, definition string")
    nodes, links = build.merge_patches(responses, slices, d)
    for df in (nodes, links):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert nodes.collect() == build.merged_nodes(responses, slices, d).collect()
    assert [(r["source"], r["target"]) for r in links.collect()] == [("s:c:13", "t")]


def test_components_go_by_numbers(spark):
    rng = random.Random(6)
    ids = [rng.randbytes(60).hex() for _ in range(3000)]
    way = rng.sample(ids, 2500)  # a path as long as that, and single nodes
    g = PropertyGraph.of(spark, [(v, "Chunk", 1) for v in ids], [(a, b, "PREREQUISITE", 1.0) for a, b in zip(way, way[1:], strict=False)])
    nodes, edges = (scratch.settle(t) for t in (g.nodes, g.edges))
    before = shuffled(spark)
    found = fixpoint.connected_components(nodes, edges, small=False)
    assert {r["id"]: r["root"] for r in found.collect()} == {v: v for v in ids} | dict.fromkeys(way, min(way))
    sent = shuffled(spark) - before
    assert sent < 1_800_000, sent


def test_depths_of_small_components_take_no_rounds(spark, monkeypatch):
    rng = random.Random(7)
    nodes = [(f"k{c}:{k}", "Chunk", rng.choice([None, 1, 4])) for c in range(40) for k in range(9)]
    edges = [(f"k{c}:{rng.randrange(9)}", f"k{c}:{rng.randrange(9)}", "Prerequisite", 1.0) for c in range(40) for _ in range(10)] + [("k1:1", "none", "PREREQUISITE", 1.0)]
    g = PropertyGraph.of(spark, nodes, edges)
    key = lambda df: {tuple(r) for r in df.select("id", "prerequisite_depth", "learning_effort").collect()}
    want = key(centrality.prerequisite_metrics(g.nodes, g.collapsed(), small=True))
    rounds = fixpoint.longest_levels
    monkeypatch.setattr(fixpoint, "longest_levels", lambda *a: pytest.fail("rounds"))
    assert key(centrality.prerequisite_metrics(g.nodes, g.collapsed(), small=False)) == want
    # Components of more rows than a task takes still go by rounds.
    monkeypatch.setattr(fixpoint, "longest_levels", rounds)
    monkeypatch.setattr(fixpoint, "SMALL", 17)
    assert key(centrality.prerequisite_metrics(g.nodes, g.collapsed(), small=False)) == want


def test_embeddings_of_a_batch_lie_in_one_array():
    texts = ["Ein Text", None, "", "ab", "Деревья и графы"]
    want = next(iter(similarity.embed_hashed(iter([pd.Series(texts)])))).tolist()
    assert similarity.embedded(pa.array(texts)).to_pylist() == want
