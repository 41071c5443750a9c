import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartolex import config
from cartolex.functions import boundaries as B
from cartolex.functions import columns as C
from cartolex.operators import build, slicing
from cartolex.sources import external, files
from cartolex.streaming import fold


def test_slug(spark):
    names = {"Алгоритмы и Структуры.txt": "algoritmy_i_struktury", "My Course Chapter 1.md": "my_course_chapter_1", "python-basics.html": "python-basics", "a.b.c.txt": "a_b_c", "Café.md": "cafe"}
    got = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in names], "f string").select("f", C.slug(F.col("f"))).collect()}
    assert got == names


def test_position_fails_on_other_ids(spark):
    df = spark.createDataFrame([("s:p:name",)], "id string").select(C.position_or_fail(F.col("id")))
    with pytest.raises(Exception, match="no position"):
        df.collect()


@given(st.text(alphabet="ab .,\n#|$`-1<>é", max_size=400), st.integers(3, 40), st.integers(0, 10))
@settings(max_examples=150, deadline=None)
def test_slices_tile_the_text(text, most, shift):
    out = slicing.slices_of(text, most, True, shift)
    if not text.strip():
        assert out == []
        return
    assert "".join(s[0] for s in out) == text
    assert [s[1] for s in out] == [0, *[s[2] for s in out[:-1]]]


@given(st.text(max_size=200))
@settings(max_examples=100, deadline=None)
def test_tokens_tile_the_text(text):
    t = B.Tokens(text)
    assert t.at[-1] == len(text) and t.at == sorted(set(t.at))


def test_windows_do_not_end_a_text_early():
    text = ("x " * 30 + "word. ") * 200
    assert "".join(s[0] for s in slicing.slices_of(text, 50, True, 5)) == text
    assert len(slicing.slices_of(" " * 3 + "abcdefghij" * 2000, 100_000, strict=True)) == 1


@pytest.mark.parametrize(
    ("before", "after", "ok"),
    [
        ("wo", "rd", False),
        ("see https://a.b/c", "/d", False),
        ("see https://a.b/c", " d", True),
        ("[text", "](http://x)", False),
        ("[text]", "(http://x)", False),
        ("<div cl", "ass=1>", False),
        ("cost $x", " + y$", False),
        ("```\ncode ", "more\n```", False),
        ("- one\n", "- two", False),
        ("- one\n", "text", True),
        ("| a | b |\n", "| c | d |", False),
        ("<table><tr>", "<td>", False),
        ("End. ", "Next", True),
    ],
)
def test_safe_cuts(before, after, ok):
    assert B.safe(before, after) is ok


def test_headers_beat_sentences():
    text = "One sentence here. Another one.\n# Title\nMore text. And more."
    at, kind, _ = B.candidates(text, 20, 40)[0]
    assert kind == "markdown_header" and text[at:].startswith("# Title")
    assert all(not text[:a].endswith("Dr. ") for a, k, _ in B.candidates("Dr. Who came. Then", 4, 20) if k == "sentence")


def test_soft_boundary():
    assert B.soft_boundary("", 0, 5) is None
    assert B.soft_boundary("One. Two three", 6, 6) == 5
    assert B.soft_boundary("abc", 1, 1) is None


@pytest.mark.parametrize(("text", "score"), [("a</h2>\n", 1.0), ("x\n## Head", 1.0), ("a\n\n", 5.0), ("End. ", 10.0), ("a\n", 15.0), ("a, ", 20.0), ("a ", 50.0), ("ab", 100.0)])
def test_quality(text, score):
    assert B.quality(text) == score


def concept(i, cid, primary, aliases):
    return (i, cid, (primary, aliases), f"d{i}")


def test_alias_fold(spark):
    rows = [concept(0, "c", "Stack", ["stack", "LIFO", "lifo", "zeta"]), concept(1, "c", "Other", ["LIFO"]), concept(2, "c", "x", ["STACK", "alpha"]), concept(3, "e", None, ["A", "a"])]
    df = spark.createDataFrame(rows, "seq long, concept_id string, term struct<primary: string, aliases: array<string>>, definition string")
    got = {r["concept_id"]: (r["term"]["primary"], r["term"]["aliases"], r["definition"]) for r in build.fold_concepts(df).collect()}
    assert got == {"c": ("Stack", ["LIFO", "alpha", "zeta"], "d0"), "e": (None, ["A"], "d3")}
    assert build.fold_concepts(df.where("seq = 0")).first()["term"]["aliases"] == ["LIFO", "zeta"]  # kept as they came


def test_mentions_of_odd_and_long_terms(spark):
    chunks = spark.createDataFrame([("a", "Chunk", "A Binary Tree and C++x; деревья."), ("b", "Chunk", "binary  tree, c++"), ("q", "Assessment", "binary tree")], "id string, type string, text string")
    d = spark.createDataFrame([("t", ("Binary tree", ["tree"]), ""), ("c", ("c++", None), ""), ("r", ("Деревья", []), "")], "concept_id string, term struct<primary: string, aliases: array<string>>, definition string")
    got = {(r["source"], r["target"]) for r in build.mentions(chunks, d).collect()}
    assert got == {("a", "t"), ("a", "c"), ("a", "r"), ("b", "t")}  # c++ needs a word character after it
    old = spark.createDataFrame([("a", "t", "MENTIONS")], "source string, target string, type string")
    assert ("a", "t") not in {(r["source"], r["target"]) for r in build.mentions(chunks, d, old).collect()}


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.txt").write_bytes("Привет".encode("cp1251"))
    (tmp_path / "raw/b.MD").write_text("# x", encoding="utf-8")
    (tmp_path / "raw/c.pdf").write_text("x")
    (tmp_path / "raw/d.txt").write_text(" \n")
    texts, rejects = files.read_raw(spark, f"{tmp_path}/raw")
    assert [tuple(r) for r in texts.collect()] == [("a.txt", "Привет"), ("b.MD", "# x")]
    assert {tuple(r) for r in rejects.collect()} == {("c.pdf", "unsupported extension"), ("d.txt", "empty")}
    s = slicing.slice_files(texts, 100)
    files.write_slices(s, f"{tmp_path}/slices")
    assert files.read_slices(spark, f"{tmp_path}/slices").collect() == s.orderBy("order").collect()


def test_graph_document_round_trip(spark, tmp_path):
    doc = {"_meta": "m", "nodes": [{"id": "b", "type": "Chunk", "text": "</script>"}, {"id": "a", "type": "Concept", "text": "y"}], "edges": [{"source": "b", "target": "a", "type": "TESTS", "weight": 0.5}]}
    (tmp_path / "g.json").write_text(json.dumps(doc))
    g = files.read_graph(spark, f"{tmp_path}/g.json")
    out = json.loads(files.graph_document(g).first()[0])
    assert [n["id"] for n in out["nodes"]] == ["b", "a"] and out["edges"][0]["weight"] == 0.5
    assert files.html_page(g).first()[0].count("</script>") == 1
    files.write_graph(g, f"{tmp_path}/t")
    assert files.read_graph_tables(spark, f"{tmp_path}/t").nodes.count() == 2
    assert files.golden_pairs(["x_graph.json", "x_graph_expected.json", "y_graph.json"]) == [("x_graph.json", "x_graph_expected.json")]


def test_stream_folds_like_the_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k, aliases in enumerate((["b"], ["B", "a"])):
        body = {"concepts_added": {"concepts": [{"concept_id": "c", "term": {"primary": "P", "aliases": aliases}, "definition": "d"}]}}
        (src / f"{k}.json").write_text(json.dumps({"slice_order": k, "slice_id": f"s{k}", "response": "```json\n" + json.dumps(body) + "\n```"}))
        os.utime(src / f"{k}.json", (1000 + k, 1000 + k))  # files are taken by their times
    q = fold.fold_stream(fold.responses_stream(spark, str(src), 1), f"{tmp_path}/out", f"{tmp_path}/check")
    q.awaitTermination(120)
    r = fold.latest(spark, f"{tmp_path}/out", 1).collect()
    assert [(x["_ord"], x["term"]["aliases"]) for x in r] == [(0, ["a", "b"])]


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text("[slicer]\nmax_tokens = 9\n")
    assert config.load(f"{tmp_path}/c.toml").slicer.max_tokens == 9
    for bad in ("[slicer]\nmax_tokens = 0\n", "[nope]\n", "[slicer]\nx = 1\n"):
        (tmp_path / "c.toml").write_text(bad)
        with pytest.raises(ValueError, match=r"max_tokens|unknown"):
            config.load(f"{tmp_path}/c.toml")


def test_external_helpers(spark):
    limits = external.Limits(texts=2, tokens=10, attempts=3)
    assert list(external.batches(["a" * 4, "b" * 4, "c" * 40, "d"], limits)) == [[0, 1], [2], [3]]
    calls, slept = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert external.with_retries(flaky, limits, sleep=slept.append) == "done" and slept == [30, 60]
    waits = []
    bucket = external.TokenBucket(60, clock=lambda: 0.0, sleep=waits.append)
    bucket.take(60)
    bucket.take(30)
    assert waits == [30.0]
    nodes = spark.createDataFrame([("a", "xx"), ("b", " ")], "id string, text string")
    vec = {r["id"]: r["vec"] for r in external.embeddings(nodes, lambda ts: [[3.0, 4.0] for _ in ts], 2).collect()}
    assert vec["b"] == [0.0, 0.0] and abs(vec["a"][0] - 0.6) < 1e-6
    assert external.prompt("a {{x}}", {"x": "b"}) == "a b"
    with pytest.raises(KeyError):
        external.prompt("{{y}}", {})
