"""Stored completions: the best items of every prefix, so serving is a lookup by key.

A row is a prefix, an item that starts with it by key or by a reading, and its place. One item more
than ``best`` is kept, which tells a list that was cut from a whole one. Prefixes have up to
``LONGEST`` characters; longer queries, and those whose list was cut too early for what is asked,
are answered from the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators.skew import best_of_key, join_lookup
from seekframe.session import materialise

BEST = 100
LONGEST = 32
BUCKETS = 64
LISTED = 500  # queries in one pushed-down filter


def names_of(items: DataFrame) -> Column:
    """All texts an item is found by: its key and its readings."""
    names = F.array(F.col("_key"))
    if "kana" in items.columns:
        names = F.concat(names, F.coalesce(F.col("kana"), F.array().cast("array<string>")))
    return names


def _spelled(items: DataFrame, longest: int) -> DataFrame:
    """A row for every prefix of every submitted item."""
    boost = F.coalesce(F.col("boost"), F.lit(0)) if "boost" in items.columns else F.lit(0)
    starts = F.flatten(F.transform(F.filter(names_of(items), lambda n: F.length(n) > 0), lambda n: F.transform(
        F.sequence(F.lit(1), F.least(F.length(n), F.lit(longest))),
        lambda size: F.substring(n, F.lit(1), size))))
    return items.filter(F.col("freq2") > 0).select(
        F.explode(F.array_distinct(starts)).alias("query"), "_key",
        F.col("freq2").cast("long").alias("freq2"), (F.col("freq2") + boost).cast("long").alias("_by"))


def _best(rows: DataFrame, best: int) -> DataFrame:
    return best_of_key(rows, ["query"], [F.desc("_by"), F.asc("_key")], best + 1, "place")


def prefix_table(items: DataFrame, best: int = BEST, longest: int = LONGEST) -> DataFrame:
    """``query, _key, freq2, _by, place``: the ``best`` items of every prefix and one more, by
    submits and boost, ties to the smaller key. Items without submits take no part. A short prefix
    that very many items share is cut in every task before rows meet."""
    return _best(_spelled(items, longest), best)


def merge_prefixes(stored: DataFrame, changed: DataFrame, best: int = BEST,
                   longest: int = LONGEST) -> DataFrame:
    """The table after ``changed`` items (with their new counters), for prefixes they start with;
    all others stay as stored. Only the changed items are spelled.

    Right as long as no item's submits plus boost fall and no reading goes, as those left out of a
    cut list are not known here: counters of a log only grow. A fall is an error.
    """
    rows = materialise(_spelled(changed, longest), "prefixes")
    new = rows.select("query", "_key", F.col("_by").alias("_new"))
    kept = join_lookup(stored, rows.select("query").distinct(), "query", "left_semi", salts=1)
    kept = kept.drop("place").join(new, ["query", "_key"], "left")
    fallen = kept.filter(F.col("_new") < F.col("_by"))
    if not fallen.isEmpty():
        raise ValueError("counters of changed items fell; make the prefix table anew")
    kept = kept.filter(F.col("_new").isNull()).drop("_new")
    return _best(kept.unionByName(rows), best)


def _bucket(query: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(query), F.lit(buckets)).cast("int")


class PrefixStore:
    """A prefix table in key buckets at ``path``, changed batch by batch."""

    def __init__(self, spark: SparkSession, path: str, best: int = BEST, longest: int = LONGEST,
                 buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.best, self.longest, self.buckets = best, longest, buckets

    def _write(self, rows: DataFrame) -> None:
        placed = rows.withColumn("_bucket", _bucket(F.col("query"), self.buckets))
        placed.hint("rebalance", F.col("_bucket")).sortWithinPartitions("_bucket", "query", "place") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("_bucket").parquet(self.path)

    def build(self, items: DataFrame) -> None:
        self._write(prefix_table(items, self.best, self.longest))

    def merge(self, changed: DataFrame) -> None:
        """Take over changed and new items. Buckets that hold a prefix of one are overwritten; given
        again after a lost driver, the same change leaves the same table."""
        stored = self.spark.read.parquet(self.path)
        fresh = materialise(merge_prefixes(stored.drop("_bucket"), changed, self.best, self.longest),
                            "merged")
        asked = fresh.select("query").distinct()
        touched = [r[0] for r in asked.select(_bucket(F.col("query"), self.buckets)).distinct().collect()]
        rest = join_lookup(stored.filter(F.col("_bucket").isin(touched)).drop("_bucket"), asked,
                           "query", "left_anti", salts=1)
        self._write(materialise(rest.unionByName(fresh), "merged"))

    def rows(self, queries: DataFrame | None = None) -> DataFrame:
        """All rows, or those of ``queries``; of a short list only the buckets are opened."""
        stored = self.spark.read.parquet(self.path)
        if queries is not None:
            asked = queries.select("query", _bucket(F.col("query"), self.buckets).alias("at"))
            listed = asked.filter(F.col("query").isNotNull()).limit(LISTED + 1).collect()
            if len(listed) <= LISTED:
                stored = stored.filter(F.col("_bucket").isin(list({r.at for r in listed}))
                                       & F.col("query").isin([r.query for r in listed]))
            else:
                stored = join_lookup(stored, queries.select("query"), "query", "left_semi", salts=1)
        return stored.drop("_bucket")

    def serve(self, queries: DataFrame, frequency_threshold: int,
              top: int | None) -> tuple[DataFrame, DataFrame]:
        """``(query, _key, _freq)`` of the queries that the table answers in full, and the ``query``
        rows that it does not: too long, or cut before the ``top``-th item that is frequent enough.
        Without ``top`` only lists that were not cut are full."""
        rows = self.rows(queries).withColumn("_freq", F.col("freq2") + 1)
        enough = F.count_if((F.col("_freq") >= frequency_threshold) & (F.col("place") <= self.best))
        whole = F.max("place") <= self.best
        full = rows.groupBy("query").agg(
            (whole if top is None else whole | (enough >= top)).alias("_full"))
        state = materialise(queries.select("query").join(full, "query", "left").select(
            "query", F.coalesce("_full", F.length("query") <= self.longest).alias("_full")), "served")
        answered = join_lookup(rows, state.filter("_full").select("query"), "query", "left_semi", salts=1)
        hits = answered.filter((F.col("_freq") >= frequency_threshold) & (F.col("place") <= self.best))
        return hits.select("query", "_key", "_freq"), state.filter(~F.col("_full")).select("query")
