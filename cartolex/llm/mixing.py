"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

Each row is repeated a Poisson number of times whose mean is its source's target repetition rate. The draw inverts the
distribution at a uniform number that md5 makes of the seed and the row's key, so it is the same wherever and however
often a task runs. The key is the row's id; rows without an id or with one id among them are told apart by their place. The output is dealt and sorted by another such hash, which is a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common as c

#: A larger mean is the sum of as many equal draws as keep each mean at or below this, so that exp(-mean) stays normal.
LARGEST_MEAN = 256.0
SEED = "mix-1"
#: The query's target: each of the twenty sources gets the same share.
TARGET = {f"src{k}": 1.0 for k in range(20)}


def uniform(*parts: Column) -> Column:
    """In (0, 1), with 48 bits, of the md5 of the parts joined by colons."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 12), 16, 10).cast("long")
    return (h + F.lit(0.5)) / F.lit(float(1 << 48))


def cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... up to where nothing is left in double precision."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    zero = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    step = lambda acc, k: F.struct((acc["p"] * mean / k).alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda acc: acc["cdf"])


def rates(docs: DataFrame, target: dict[str, float], total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(source, rate) of the sources that have a target, and one row with the rate of all others.

    A source's rate is share * total / rows, where total is the rows of docs unless given. Sources (or null) without a
    target keep their natural share together: total / all rows. Rows are counted over the whole table. The first result
    has a row for each entry of target at most, whatever the table.
    """
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(k, float(v)) for k, v in target.items()], "__wanted string, weight double")
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    joined = counts.join(F.broadcast(wanted), counts["source"] == wanted["__wanted"], "left").drop("__wanted")  # as large as target
    # Sources without a target become one row.
    joined = joined.groupBy(F.when(F.col("weight").isNotNull(), F.col("source")).alias("source"), "weight").agg(F.sum("rows").alias("rows"))
    every = W.partitionBy()  # len(target) + 1 rows at most
    sums = joined.withColumns({
        "all": F.sum("rows").over(every),
        "weights": F.sum("weight").over(every),
        "free": F.sum(F.when(F.col("weight").isNull(), F.col("rows")).otherwise(0)).over(every),
    }).withColumn("total", F.coalesce(F.lit(total).cast("double"), F.col("all").cast("double")))
    share = F.col("weight") / F.col("weights") * (F.col("all") - F.col("free")) / F.col("all")
    out = sums.select("source", "weight", F.when(F.col("weight").isNull(), F.col("total") / F.col("all")).otherwise(share * F.col("total") / F.col("rows")).alias("rate"))
    return out.where("weight IS NOT NULL").select("source", "rate"), out.agg(F.coalesce(F.max(F.when(F.col("weight").isNull(), F.col("rate"))), F.lit(1.0)).alias("rate"))


def _drawn(rate: DataFrame) -> DataFrame:
    out = rate.withColumn("__draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int"))
    return out.withColumn("__cdf", cumulative(F.col("rate") / F.col("__draws"))).drop("rate")


#: Repeated ids up to which they are broadcast (some 50 bytes each); beyond it their rows are joined by a shuffle.
REPEATED = 100_000


def keyed(docs: DataFrame) -> DataFrame:
    """docs with __key: the id as text where one row has it, else the id (or the word null), a hash of the row and its
    place in the table, so that each of several rows of an id, or without one, is drawn by itself.

    The place is the number of the partition and the row's number there: it repeats when a task runs again on the same
    files, but not on files cut otherwise.
    """
    own = F.col("doc_id").cast("string")
    place = F.concat_ws(":", F.coalesce(own, F.lit("null")), F.xxhash64(*[F.col(f"`{x}`") for x in docs.columns]).cast("string"), F.monotonically_increasing_id().cast("string"))
    rows = docs.withColumn("__place", place)
    again = c.cut(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select("__id"), "repeated")
    n = again.limit(REPEATED + 1).count()
    if not n:
        return rows.withColumn("__key", F.coalesce(own, "__place")).drop("__place")
    again = F.broadcast(again) if n <= REPEATED else again
    rows = rows.join(again, rows["doc_id"] == again["__id"], "left")
    return rows.withColumn("__key", F.when(F.col("doc_id").isNull() | F.col("__id").isNotNull(), F.col("__place")).otherwise(own)).drop("__place", "__id")


def mix_sources(docs: DataFrame, target: dict[str, float], seed: str = SEED, total: float | None = None, order: bool = True) -> DataFrame:
    """docs with every row repeated by its draw, plus copy_no (from 0) and shuffle_key, in the order of shuffle_key.

    Each row has a draw of its own: rows with one id, equal rows and rows without an id too (see keyed()). A null source
    counts as one without a target; texts may be null, empty or of any length. Other columns are carried along, and an
    input column named copy_no or shuffle_key (or with two leading underscores, as those used here) gives way. An empty
    table gives no rows. What is broadcast has a row for each entry of target, or REPEATED rows, at most.
    """
    docs = docs.drop("copy_no", "shuffle_key", "__key", "__place", "__id", "__rows", "__wanted", "__source", "__draws", "__cdf", "__draws0", "__cdf0", "__n")
    named, others = rates(docs, target, total)
    named = _drawn(named).withColumnsRenamed({"source": "__source"})
    others = _drawn(others).withColumnsRenamed({"__draws": "__draws0", "__cdf": "__cdf0"})
    rows = keyed(docs)
    own = rows.join(F.broadcast(named), rows["source"] == named["__source"], "left").crossJoin(F.broadcast(others))  # one row
    own = own.withColumn("__draws", F.coalesce("__draws", "__draws0")).withColumn("__cdf", F.coalesce("__cdf", "__cdf0"))
    doc = F.col("__key")
    one = lambda k: F.size(F.filter(F.col("__cdf"), lambda p: p < uniform(F.lit(seed), doc, k.cast("string"))))
    count = F.when(F.col("__draws") == 1, one(F.lit(0))).otherwise(F.aggregate(F.sequence(F.lit(0), F.col("__draws") - 1), F.lit(0), lambda acc, k: acc + one(k)))
    out = own.withColumn("__n", count).where("__n > 0").select(*docs.columns, "__key", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy_no"))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), doc, F.col("copy_no").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    out = out.withColumn("shuffle_key", key).drop("__key")
    if not order:
        return out
    return out.repartition(max(c.parts_for(docs, 16), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shuffle_key").sortWithinPartitions("shuffle_key")


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(c.table(spark, sf_dir, "documents"), TARGET)


OP4_SQL = f"""
WITH n AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source),
w AS (SELECT n.*, CASE WHEN source IN ({", ".join(f"'{s}'" for s in TARGET)}) THEN 1.0::DOUBLE END AS weight FROM n),
s AS (SELECT sum(n_rows)::DOUBLE AS total, sum(weight) AS weights, sum(CASE WHEN weight IS NULL THEN n_rows ELSE 0 END) AS free FROM w),
r AS (SELECT source, CASE WHEN weight IS NULL THEN 1.0::DOUBLE ELSE weight / weights * (total - free) / total * total / n_rows END AS rate FROM w, s),
k AS (SELECT source, rate, unnest(range(0, 25 + ceil(rate + 12 * sqrt(rate))::BIGINT)) AS k FROM r),
p AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM k),
f AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
a AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM f GROUP BY source),
u AS (SELECT d.*, a.cdf, (CAST('0x' || substr(md5('{SEED}:' || d.doc_id || ':0'), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0 AS u
      FROM documents d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
e AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, len(list_filter(cdf, lambda x: x < u)))) AS copy_no FROM u)
SELECT doc_id, text, lang, source, n_chars, copy_no::INTEGER AS copy_no,
       CAST('0x' || substr(md5('{SEED}:order:' || doc_id || ':' || copy_no), 1, 15) AS BIGINT) AS shuffle_key
FROM e
"""
