"""Item statistics that follow the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seekframe.operators.suggest import item_stats

SCHEMA = T.StructType([
    T.StructField("_key", T.StringType()), T.StructField("freq", T.LongType()),
    T.StructField("freq2", T.LongType()), T.StructField("last", T.TimestampNTZType()),
    T.StructField("batch", T.LongType()),
])


def start_item_stats(events: DataFrame, updates: str, checkpoint: str) -> StreamingQuery:
    """Keep the counters of :func:`item_stats` in the state store; every micro-batch writes the
    items it touched to its own folder below ``updates``, so repeating a batch changes nothing."""
    def write(touched: DataFrame, batch: int) -> None:
        touched.withColumn("last", F.col("last").cast("timestamp_ntz")) \
            .write.mode("overwrite").parquet(f"{updates}/batch={batch}")

    return (item_stats(events).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_item_stats(spark: SparkSession, updates: str) -> DataFrame:
    """The latest counters of every item: those of the last batch that touched it."""
    rows = spark.read.schema(SCHEMA).parquet(updates)
    latest = rows.groupBy("_key").agg(
        F.max_by(F.struct("freq", "freq2", "last"), "batch").alias("_row"))
    return latest.select("_key", "_row.*")


def current_item_stats(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The counters of every item as the state store of :func:`start_item_stats` holds them: one row
    an item, however many batches there were. ``batch`` asks for the state after an earlier batch
    that the checkpoint still keeps. The stream has to have finished one batch."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    # State has the aggregates in their order, two of them under one name.
    counters = F.col("value").cast("struct<freq: bigint, freq2: bigint, last: timestamp_ntz>")
    return reader.load(checkpoint).select(F.col("key.item").alias("_key"), counters.alias("_row")) \
        .select("_key", "_row.*")
