"""Structured Streaming over the event table; results equal those of the batch learners."""

from pyspark.sql import functions as F

from seekframe.operators.suggest import prepare_events
from seekframe.plans.registry import PAIR_DAY, query
from seekframe.plans.sql import EVENT_PAIRS, FOLLOWED, ITEMS, log_with
from seekframe.session import scratch_path
from seekframe.streaming.item_stats import current_item_stats, read_item_stats, start_item_stats
from seekframe.streaming.pairs import PairLearner


def _stream(t):
    rows = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet") \
        .parquet(t.folder)
    return prepare_events(
        rows, id=F.col("event_id"), sequence=F.col("user_id"), time=F.col("ts"),
        item=F.get_json_object("props", "$.k"), submit=F.col("event_type") == "purchase")


@query(f"{log_with(ITEMS)} SELECT _key, freq, freq2, last FROM items")
def stream_item_stats(t):
    updates = scratch_path(t.spark, "item-updates")
    start_item_stats(_stream(t), updates, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return read_item_stats(t.spark, updates)


@query(f"{log_with(ITEMS)} SELECT _key, freq, freq2, last FROM items")
def stream_item_counters(t):
    """As ``stream_item_stats``, read from the state store: no batch of the past is opened."""
    checkpoint = scratch_path(t.spark, "checkpoint")
    start_item_stats(_stream(t), scratch_path(t.spark, "item-updates"), checkpoint).awaitTermination()
    return current_item_stats(t.spark, checkpoint)


@query(f"{log_with(FOLLOWED, EVENT_PAIRS)} SELECT pre, post, freq0, freq1 FROM event_pairs")
def stream_pairs(t):
    learner = PairLearner(t.spark, scratch_path(t.spark, "pairs"), PAIR_DAY)
    learner.start(_stream(t), scratch_path(t.spark, "checkpoint")).awaitTermination()
    return learner.pairs()
