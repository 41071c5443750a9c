"""Every query that SQL can express gives DuckDB's rows, on the smallest tables."""

import os

import duckdb
import pytest

from cartolex.operators import centrality
from cartolex.plans import catalogue, fixtures

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def rounded(v):
    if v is None or v != v:
        return None
    if isinstance(v, (bool, int)):
        return float(v)
    try:
        return round(float(v), 5)
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS FROM '{SF}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.execute(catalogue.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    key = lambda rows: sorted([tuple(map(rounded, r)) for r in rows], key=str)
    assert key(tuple(r[c] for c in columns) for r in got.collect()) == key(want.fetchall())


def test_pagerank_ranks_all_purchases(spark, duck):
    links = duck.execute("SELECT s, t, 1.0::DOUBLE / (1 + count(*)) FROM (SELECT l_partkey AS s, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS t FROM lineitem) WHERE s <> t GROUP BY s, t").fetchall()
    parts = [k for (k,) in duck.execute("SELECT p_partkey FROM part").fetchall()]
    total = dict.fromkeys(parts, 0.0)
    for s, _, w in links:
        total[s] += w
    x = dict.fromkeys(parts, 1 / len(parts))
    for _ in range(100):
        new = dict.fromkeys(parts, (0.15 + 0.85 * sum(x[v] for v in parts if not total[v])) / len(parts))
        for s, t, w in links:
            new[t] += 0.85 * x[s] * w / total[s]
        x = new
    g = fixtures.purchases(spark, SF)
    assert g.edges.count() == len(links)
    for ranks in (catalogue.QUERIES["q_pagerank"](spark, SF), centrality.pagerank(g.nodes, g.collapsed(), small=False)):
        got = {r["id"]: r["pagerank"] for r in ranks.collect()}
        assert got.keys() == {f"p:c:{k}" for k in parts}
        assert sum(abs(got[f"p:c:{k}"] - x[k]) for k in parts) < 2e-3


def test_metrics_without_sql_take_all_nation_pairs(spark, duck):
    pairs = duck.execute("SELECT DISTINCT 'n:c:' || s_nationkey, 'n:c:' || c_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey").fetchall()
    assert len(pairs) > 100  # more than 4 a nation
    got = [(r["source"], r["target"]) for r in catalogue.QUERIES["q_all_edge_metrics"](spark, SF).collect()]
    assert sorted(got) == sorted(pairs)
