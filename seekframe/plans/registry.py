"""Registered queries: a function over the tables, and the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators import suggest
from seekframe.operators.impacts import build_impacts, write_impacts
from seekframe.operators.index import BUCKETS, build_postings, read_index, write_index
from seekframe.operators.lexicon import held_tokens, write_lexicon
from seekframe.session import materialise, scratch_path, spread

PAIR_DAY = 86_400  # events of one user are hours apart, so pairs are learned over a day

_INDEXES: dict[tuple[str, str], str] = {}


class Tables:
    """The Parquet tables of one folder, read on use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def texts(self) -> DataFrame:
        """The documents, for queries that cut every text into tokens."""
        return spread(self.__getattr__("documents"))

    @property
    def stored_index(self) -> str:
        """Where the postings of the documents are stored: written once for a folder and session, as
        an index job would, so a lookup is timed as a lookup. Buckets hold about 32 MB of text."""
        built = (self.spark.sparkContext.applicationId, self.folder)
        if built not in _INDEXES:
            path = scratch_path(self.spark, "index")
            size = self.__getattr__("documents").agg(F.sum(F.octet_length("text"))).scalar()
            buckets = self.spark.range(1).select(F.coalesce(size, F.lit(0))).head()[0] // (32 << 20) + 4
            write_index(build_postings(self.texts, "doc_id", ["text"]), "doc_id", path, int(buckets))
            _INDEXES[built] = path
        return _INDEXES[built]

    @property
    def stored_impacts(self) -> str:
        """Where the impacts of that index are stored, written once like it."""
        built = (self.spark.sparkContext.applicationId, self.folder + "#impacts")
        if built not in _INDEXES:
            path = scratch_path(self.spark, "impacts")
            index = self.stored_index
            held = self.spark.read.parquet(index).select("_buckets").head()
            write_impacts(build_impacts(read_index(self.spark, index), "doc_id", 256,
                                        held[0] if held else BUCKETS), path, 4)
            _INDEXES[built] = path
        return _INDEXES[built]

    @property
    def stored_lexicon(self) -> tuple[str, str]:
        """Where the distinct tokens of every document are stored, and their lexicon, written once."""
        built = (self.spark.sparkContext.applicationId, self.folder + "#lexicon")
        if built not in _INDEXES:
            path = scratch_path(self.spark, "lexicon")
            write_index(held_tokens(self.texts, "doc_id", "text"), "doc_id", f"{path}/held", 16)
            write_lexicon(read_index(self.spark, f"{path}/held"), f"{path}/lexicon", 16)
            _INDEXES[built] = path
        return f"{_INDEXES[built]}/held", f"{_INDEXES[built]}/lexicon"

    @cached_property
    def log(self) -> DataFrame:
        """The event table as a query log: purchases are submits, items come from ``props``."""
        return suggest.prepare_events(
            self.__getattr__("events"), id=F.col("event_id"), sequence=F.col("user_id"),
            time=F.col("ts"), item=F.get_json_object("props", "$.k"),
            submit=F.col("event_type") == "purchase")

    @cached_property
    def learned(self) -> tuple[DataFrame, DataFrame]:
        """Item and pair tables learned from the log, written once as a learning job would."""
        items = materialise(suggest.item_stats(self.log), "items")
        return items, materialise(suggest.learn_pairs(self.log, items, PAIR_DAY), "pairs")

    @cached_property
    def catalogue(self) -> tuple[DataFrame, DataFrame]:
        """Part names as submitted items, counted by sold lines; their words are the readings."""
        sold = self.__getattr__("lineitem").groupBy("l_partkey").agg(F.count("*").alias("lines"))
        names = self.__getattr__("part").join(sold, F.col("p_partkey") == F.col("l_partkey"))
        items = names.groupBy(F.col("p_name").alias("_key")).agg(
            F.count("*").alias("freq"), F.sum("lines").alias("freq2"),
            F.max("p_size").alias("boost")) \
            .withColumn("kana", F.split(F.lower("_key"), " "))
        items = materialise(items, "catalogue")
        zero = F.lit(0).cast("long")
        pairs = suggest.pairs_related(items).select(
            "pre", "post", zero.alias("freq0"), zero.alias("freq1"), "freq2")
        return items, pairs


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated function under its name."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return add
