"""Tables that cut a plan's lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_own: list[str] = []
#: Rows of a table that each executor may hold, and the driver passes on.
FEW = 300_000


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session with a local master may go without it."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="cartolex-scratch-"))
    return f"file://{_own[0]}"


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """df written once and read back, so that a loop's plan stays short and a lost executor costs one step at most."""
    path = f"{folder(df.sparkSession)}/cartolex-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cartolex_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove tables that settle() wrote, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_cartolex_path", None)
        if path:
            jvm, spark = df.sparkSession._jvm, df.sparkSession
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def shared(df: DataFrame, most: int | None = None) -> DataFrame:
    """df, a settled table of short rows, to be broadcast if it has few rows (checked); else joins shuffle as they must."""
    most = FEW if most is None else most
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _placed(df: DataFrame, *order) -> DataFrame:
    """df settled in the order given, with __part and __at: a global sort's partitions and places."""
    placed = settle(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    return placed.withColumn("__part", F.shiftright("__at", 33))


def _before(sums: DataFrame) -> DataFrame:
    """__part, __before: the sum of __rows in the partitions before; one row a partition."""
    return sums.select("__part", (F.coalesce(F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("__before"))


def in_order(df: DataFrame, *order) -> DataFrame:
    """df with __n, its rows' numbers from 0 in the order given: a global sort, then each partition's rows after those of
    the partitions before it. One row a partition meets in one task, never the table."""
    placed = _placed(df, *order)
    before = _before(placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows")))
    numbered = placed.join(F.broadcast(before), "__part")  # one row a partition
    return numbered.withColumn("__n", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__before", "__at")


def sums_before(df: DataFrame, value: str, *order) -> DataFrame:
    """df with __n, the sum of a whole-numbered value over the rows before, in the order given; as in in_order()."""
    placed = _placed(df, *order)
    before = _before(placed.groupBy("__part").agg(F.sum(value).alias("__rows")))
    own = F.sum(value).over(W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, -1))
    return placed.withColumn("__n", F.coalesce(own, F.lit(0))).join(F.broadcast(before), "__part").withColumn("__n", F.col("__n") + F.col("__before")).drop("__part", "__before", "__at")
