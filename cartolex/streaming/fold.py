"""The dictionary fold as a stream: new answers of slices are folded into a table, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns as C
from ..operators import build

RESPONSES = "slice_order INT, slice_id STRING, response STRING"


def responses_stream(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(RESPONSES).option("maxFilesPerTrigger", per_trigger).json(path)


def concepts_of(responses: DataFrame) -> DataFrame:
    """seq, concept_id, term, definition of each concept in the answers; works on streams too."""
    parsed = responses.select("slice_order", F.from_json(C.cleaned_json(F.col("response")), build.CONCEPT_PATCH).alias("p"))
    each = parsed.select("slice_order", F.posexplode("p.concepts_added.concepts").alias("pos", "c"))
    return each.select(build.sequence("slice_order").alias("seq"), "c.concept_id", "c.term", "c.definition")


def fold_stream(responses: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Folds each micro-batch into the parquet folder `table`, one version a batch: what a concept has so far counts as its
    first occurrence. Batches must come in the order of the slices. A batch that runs again writes the same version again,
    from the one before it, so that a restart neither loses nor repeats anything."""
    spark = responses.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        new = concepts_of(batch)
        if number:
            old = spark.read.parquet(f"{table}/v{number - 1}").select((F.col("_ord") - (1 << 62)).alias("seq"), "concept_id", "term", "definition")
            new = old.unionByName(new)
        folded = build.fold_concepts(new)
        folded.withColumn("_ord", F.when(F.col("_ord") < 0, F.col("_ord") + (1 << 62)).otherwise(F.col("_ord"))).write.mode("overwrite").parquet(f"{table}/v{number}")

    return responses.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, table: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{table}/v{number}")
