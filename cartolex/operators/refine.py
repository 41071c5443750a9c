"""Edges that a model proposes: validation, and their merge into the graph."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S

ADDED, FIXED = "added_by=refiner_longrange_v1", "fixed_by=refiner_longrange_v1"
RESPONSE = "array<struct<source: string, target: string, type: string, weight: string, conditions: string>>"


def model_edges(responses: DataFrame, candidates: DataFrame) -> DataFrame:
    """seq, source, target, type, weight, conditions of the valid edges in responses (seq, source_id, response).

    An edge must have a type of the nine, start at the node that was asked about and end at one of its candidates
    (source_id, target_id). A weight outside [0, 1] or no number becomes 0.5. PREREQUISITE self-loops are dropped.
    """
    parsed = responses.select("seq", "source_id", F.posexplode(F.from_json("response", RESPONSE)).alias("pos", "e")).select("seq", "pos", "source_id", "e.*")
    ok = parsed.where(F.col("type").isin(*S.EDGE_TYPES) & (F.col("source") == F.col("source_id")) & ~((F.col("type") == "PREREQUISITE") & (F.col("source") == F.col("target"))))
    ok = ok.join(candidates.select("source_id", F.col("target_id").alias("target")).distinct(), ["source_id", "target"], "left_semi")
    w = F.coalesce(F.col("weight").try_cast("double"), F.lit(S.WEIGHT_MERGE))
    weight = F.when((w >= 0) & (w <= 1), w).otherwise(F.lit(S.WEIGHT_MERGE))
    return ok.select((F.shiftleft(F.col("seq").cast("long"), 31) + F.col("pos")).alias("seq"), "source", "target", "type", weight.alias("weight"), F.coalesce("conditions", F.lit("")).alias("conditions"))


def _merge(g: pd.DataFrame) -> pd.DataFrame:
    """One (source, target): existing edges (seq null) in order, then the new ones by seq. Rows kept, and what was done."""
    old = g[g["seq"].isna()].sort_values("_ord")
    rows = [{"_ord": int(o), "at": None, "type": t, "weight": w, "conditions": c} for o, t, w, c in zip(old["_ord"], old["type"], old["weight"], old["conditions"], strict=True)]
    log = []
    known = lambda r: S.WEIGHT_MERGE if r["weight"] is None or pd.isna(r["weight"]) else r["weight"]
    for n in g[g["seq"].notna()].sort_values("seq").itertuples():
        fresh = {"_ord": None, "at": int(n.seq), "type": n.type, "weight": n.weight}
        same = next((r for r in rows if r["type"] == n.type), None)
        if not rows:
            rows.append(fresh | {"conditions": ADDED})
            log.append(("added", n.type))
        elif same is not None:
            if n.weight > known(same):
                same["weight"] = n.weight
                log.append(("updated", n.type))
            else:
                log.append(("kept", n.type))
        elif n.weight >= max(map(known, rows)):
            log += [("replaced", f"{r['type']}->{n.type}") for r in rows]
            rows = [fresh | {"conditions": FIXED}]
        else:
            log.append(("kept", n.type))
    source, target = g["source"].iloc[0], g["target"].iloc[0]
    out = [("edge", r["_ord"], r["at"], r["type"], r["weight"], r["conditions"]) for r in rows if not (r["type"] == "PREREQUISITE" and source == target)]
    out += [("dropped", None, None, r["type"], r["weight"], None) for r in rows if r["type"] == "PREREQUISITE" and source == target]
    out += [(op, None, None, t, None, None) for op, t in log]
    df = pd.DataFrame(out, columns=["op", "_ord", "seq", "type", "weight", "conditions"])
    df.insert(1, "source", source)
    df.insert(2, "target", target)
    return df


def upsert(edges: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph's edges after new ones (seq, source, target, type, weight) are merged in by seq, and an audit of what
    was done (op, source, target, type).

    For each (source, target): without an edge the new one is added; one of its type gets the larger weight; else it
    replaces all if it weighs at least as much as each. Then PREREQUISITE self-loops go. Only pairs that new edges touch
    are folded, each by itself; added and replacing edges follow the others in order.
    """
    pairs = new.select("source", "target").distinct()
    touched = edges.join(pairs, ["source", "target"], "left_semi")
    rest = edges.join(pairs, ["source", "target"], "left_anti").where("NOT (type = 'PREREQUISITE' AND source = target)")
    both = touched.select("_ord", F.lit(None).cast("long").alias("seq"), "source", "target", "type", "weight", "conditions").unionByName(new.select(F.lit(None).cast("long").alias("_ord"), "seq", "source", "target", "type", "weight", F.lit(None).cast("string").alias("conditions")))
    done = both.groupBy("source", "target").applyInPandas(_merge, "op string, source string, target string, _ord long, seq long, type string, weight double, conditions string")
    last = edges.agg(F.coalesce(F.max("_ord"), F.lit(-1)).alias("last"))
    kept = done.where("op = 'edge'").crossJoin(F.broadcast(last)).select(F.coalesce("_ord", F.col("last") + 1 + F.col("seq")).alias("_ord"), "source", "target", "type", "weight", "conditions")
    return rest.select("_ord", "source", "target", "type", "weight", "conditions").unionByName(kept), done.where("op <> 'edge'").select("op", "source", "target", "type")


def usage_totals(calls: DataFrame) -> DataFrame:
    """stage, requests, input_tokens, output_tokens: what a service was asked, of one row a call (stage, input_tokens,
    output_tokens; no number counts as 0)."""
    total = lambda c: F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c)
    return calls.groupBy("stage").agg(F.count(F.lit(1)).alias("requests"), total("input_tokens"), total("output_tokens"))


def operation_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("op", "type").agg(F.count(F.lit(1)).alias("n"))
