"""Files in and out: raw texts, slices, graphs, dictionaries, maps, reports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..graph import PropertyGraph

EXTENSIONS = ("txt", "md", "html")
ENCODINGS = ("utf-8", "cp1251", "latin-1")


def read_raw(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS) -> tuple[DataFrame, DataFrame]:
    """(source_file, text) of files with the extensions in any case, decoded by the first encoding that fits; and rejects
    (source_file, reason): other extensions, and files that are blank."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), "content")

    @F.pandas_udf("string")
    def decode(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in contents:
            out = []
            for raw in s:
                for encoding in ENCODINGS:
                    try:
                        out.append(bytes(raw).decode(encoding))
                        break
                    except UnicodeDecodeError:
                        continue
            yield pd.Series(out)

    known = F.lower(F.regexp_extract("source_file", r"\.([^.]+)$", 1)).isin(*extensions)
    texts = files.where(known).select("source_file", decode("content").alias("text"))
    blank = ~F.col("text").rlike(r"(?U)\S")
    rejects = files.where(~known).select("source_file", F.lit("unsupported extension").alias("reason")).unionByName(texts.where(blank).select("source_file", F.lit("empty").alias("reason")))
    return texts.where(~blank).orderBy("source_file"), rejects


def write_slices(slices: DataFrame, path: str) -> None:
    slices.write.mode("overwrite").json(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """Slices by their order (file names alone would put slice_1000 before slice_101)."""
    return spark.read.schema(S.SLICE).option("pathGlobFilter", "*.json").json(path).orderBy("order")


def read_graph(spark: SparkSession, path: str) -> PropertyGraph:
    """A graph from one JSON document {_meta, nodes, edges}, or from the tables that write_graph() makes."""
    doc = spark.read.schema(S.GRAPH_JSON).option("multiLine", True).json(path)
    part = lambda name: doc.select(F.posexplode(name).alias("p", "x")).select(F.col("p").cast("long").alias("_ord"), "x.*")
    return PropertyGraph(part("nodes"), part("edges"))


def read_graph_tables(spark: SparkSession, path: str) -> PropertyGraph:
    return PropertyGraph(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))


def write_graph(graph: PropertyGraph, path: str) -> None:
    graph.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    graph.edges.write.mode("overwrite").parquet(f"{path}/edges")


def graph_document(graph: PropertyGraph, meta: dict[str, str] | None = None) -> DataFrame:
    """One row `value`: the graph as a single JSON document, for tools that want one. Its size is that of one value, so it
    is for graphs that a viewer can show (take top_nodes() of others)."""
    listed = lambda df: df.agg(F.transform(F.array_sort(F.collect_list(F.struct("_ord", F.struct(*[c for c in df.columns if c != "_ord"]).alias("x")))), lambda r: r["x"]).alias("v"))
    n, e = listed(graph.nodes).withColumnRenamed("v", "nodes"), listed(graph.edges).withColumnRenamed("v", "edges")
    m = F.create_map(*[F.lit(v) for kv in (meta or {}).items() for v in kv]) if meta else F.create_map().cast("map<string,string>")
    return n.crossJoin(e).select(F.to_json(F.struct(m.alias("_meta"), "nodes", "edges")).alias("value"))  # one row each


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(S.DICTIONARY_JSON).option("multiLine", True).json(path)
    return doc.select(F.posexplode("concepts").alias("p", "x")).select(F.col("p").cast("long").alias("_ord"), "x.*")


def write_dictionary(concepts: DataFrame, path: str, stats: DataFrame | None = None) -> None:
    """The dictionary's table, and beside it, under path + "_meta", its statistics as JSON."""
    concepts.write.mode("overwrite").parquet(path)
    if stats is not None:
        stats.write.mode("overwrite").json(f"{path}_meta")


def write_duplicate_map(rows: DataFrame, path: str) -> None:
    rows.orderBy("duplicate_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def html_page(graph: PropertyGraph, title: str = "graph") -> DataFrame:
    """One row `value`: a page that carries the graph's data inline and lists its nodes and edges, without other files."""
    # Within a script element, "</" must not occur in the data.
    data = F.replace("value", F.lit("</"), F.lit("<\\/"))
    head = f"<!doctype html><html><head><meta charset=\"utf-8\"><title>{title}</title></head><body><h1>{title}</h1><input id=q placeholder=search><ul id=list></ul><script>const G="
    tail = ";const U=document.getElementById('list');function show(q){U.innerHTML='';G.nodes.filter(n=>(n.id+' '+(n.text||'')+' '+(n.definition||'')).toLowerCase().includes(q)).forEach(n=>{const li=document.createElement('li');li.textContent=n.type+' '+n.id+': '+(n.text||'');U.appendChild(li)})}document.getElementById('q').oninput=e=>show(e.target.value.toLowerCase());show('');</script></body></html>"
    return graph_document(graph).select(F.concat(F.lit(head), data, F.lit(tail)).alias("value"))


def golden_pairs(names: list[str]) -> list[tuple[str, str]]:
    """(graph, expected) file names that belong together, of a listing."""
    have = set(names)
    return sorted((n, e) for n in have if n.endswith("_graph.json") and (e := n.removesuffix(".json") + "_expected.json") in have)
