"""Pair learning that follows the event stream.

Each micro-batch runs the batch learner over its events plus those still waiting for a submit. The
waiting events are a table in the shared folder, one version per batch: state grows with the pair
window, a hot sequence is chunked as in the batch job, and repeating a batch gives the same files.

Arrival ids order the events of a sequence, and agree with their times. A pair is final once the watermark (latest time seen,
less ``delay_seconds``) has passed its submit. Events older than the watermark of the batch before
are too late to be paired; they go whole to the ``late`` table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seekframe.operators.suggest import CHUNK_ROWS, PAIR_SECONDS, with_next_submit

EVENT = T.StructType([
    T.StructField("_id", T.LongType()), T.StructField("sequence", T.StringType()),
    T.StructField("time", T.TimestampNTZType()), T.StructField("item", T.StringType()),
    T.StructField("type", T.StringType()),
])
PAIR = T.StructType([
    T.StructField("pre", T.StringType()), T.StructField("post", T.StringType()),
    T.StructField("freq0", T.LongType()), T.StructField("freq1", T.LongType()),
])
MARK = T.StructType([T.StructField("watermark", T.TimestampNTZType())])


class PairLearner:
    """Tables below ``root``: ``pairs``, ``waiting``, ``late`` and ``mark``, a folder per batch."""

    def __init__(self, spark: SparkSession, root: str, seconds: float = PAIR_SECONDS,
                 delay_seconds: float = 0.0, chunk_rows: int = CHUNK_ROWS):
        self.spark, self.root = spark, root.rstrip("/")
        self.window = dt.timedelta(seconds=seconds)
        self.delay = dt.timedelta(seconds=delay_seconds)
        self.chunk_rows = chunk_rows

    def _path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def _before(self, table: str, batch: int, schema: T.StructType) -> DataFrame:
        if batch == 0:
            return self.spark.range(0).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        return self.spark.read.schema(schema).parquet(self._path(table, batch - 1))

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self._path(table, batch))

    def process(self, new: DataFrame, batch: int) -> None:
        """One micro-batch; ``batch`` numbers start at 0 and have no gaps."""
        new = new.select(*[F.col(f.name).cast(f.dataType) for f in EVENT.fields]).persist()
        mark = self._before("mark", batch, MARK)
        passed = mark.select("watermark").scalar() if batch else F.lit(None).cast("timestamp_ntz")
        is_late = F.coalesce(F.col("time") < passed, F.lit(False))
        self._write(new.filter(is_late), "late", batch)
        latest = new.agg(F.max("time").alias("watermark")) \
            .select((F.col("watermark") - F.lit(self.delay)).alias("watermark")) \
            .unionByName(mark).agg(F.max("watermark").alias("watermark"))
        self._write(latest, "mark", batch)
        watermark = self.spark.read.schema(MARK).parquet(self._path("mark", batch)) \
            .select("watermark").scalar()

        open_events = self._before("waiting", batch, EVENT).unionByName(new.filter(~is_late))
        followed = with_next_submit(open_events, self.chunk_rows).persist()
        answered = F.col("_next").isNotNull() & (F.col("_next.time") <= watermark)
        gap = F.col("_next.time") - F.col("time")
        in_time = gap.between(F.lit(dt.timedelta(0)), F.lit(self.window))
        submitted = F.col("type") == "submit"
        pairs = followed.filter(answered & in_time).groupBy(
            F.col("item").alias("pre"), F.col("_next.item").alias("post")).agg(
            F.count_if(~submitted).alias("freq0"), F.count_if(submitted).alias("freq1"))
        self._write(pairs, "pairs", batch)

        # Unanswered events wait while a submit could still reach them. A submit after the
        # watermark also waits: it is the answer to events that wait.
        reachable = F.col("time") + F.lit(self.window) >= watermark
        still = (~F.coalesce(answered, F.lit(False)) & reachable) \
            | (submitted & (F.col("time") > watermark))
        self._write(followed.filter(still).select(*EVENT.names), "waiting", batch)
        followed.unpersist()
        new.unpersist()

    def start(self, events: DataFrame, checkpoint: str) -> StreamingQuery:
        return (events.writeStream.foreachBatch(self.process)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    def pairs(self) -> DataFrame:
        """All pairs learned so far."""
        rows = self.spark.read.schema(PAIR).parquet(f"{self.root}/pairs")
        return rows.groupBy("pre", "post").agg(
            *[F.sum(c).alias(c) for c in ("freq0", "freq1")])

    def late(self) -> DataFrame:
        return self.spark.read.schema(EVENT).parquet(f"{self.root}/late")
