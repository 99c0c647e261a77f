"""The best rows of a term query from an index, opening only ranges of ids that can hold one.

Beside the postings lies a small table of impacts: for each token and range of ids the largest score
of one document. The sum over the terms of a query bounds every score in a range. The ranges with
the largest bounds are scored first; their k-th score is a floor, and ranges bounded below it are
never opened.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators.index import (
    BUCKETS,
    PACK_ROWS,
    folded,
    gathered,
    match_terms,
    packed,
    read_index,
    unpacked,
    write_index,
)
from seekframe.operators.skew import join_lookup
from seekframe.session import materialise

RANGE_ROWS = 4096  # ids of a range
PART_POSTINGS = 1 << 19  # postings whose impacts one task makes together
PART_IDS = 1 << 14  # of neighbouring ids, so that a token of all documents is dealt too
INTERVALS = 500  # ranges of ids in one pushed-down filter


def build_impacts(index: DataFrame, id_col: str, range_rows: int = RANGE_ROWS,
                  buckets: int = BUCKETS) -> DataFrame:
    """``token, start, width, most, docs``: for each token and range of whole-number ids the largest
    score of a document and the number of documents. Scores are those of ``match_terms``.

    Occurrences of a document combine in each task, are shuffled in packs of tokens and ranges that
    belong together, and combine there before documents meet in their range. Packs are large where
    postings come in the order they are stored in, in ``buckets``.
    """
    amount = F.col("weight") if "weight" in index.columns else F.lit(1)
    total = index.agg(F.sum(amount).alias("most")).schema["most"].dataType
    whole = F.col(id_col).cast("long")
    start = whole - F.pmod(whole, F.lit(range_rows))
    parts = index.count() // PART_POSTINGS + 1
    near = F.call_function("div", start, F.lit(PART_IDS // range_rows * range_rows or range_rows))
    part = F.pmod(F.xxhash64(F.pmod(F.xxhash64("token"), F.lit(buckets)), near), F.lit(parts)).cast("int")
    rows = index.select("token", F.col(id_col).alias("id"), start.alias("start"),
                        amount.cast(total).alias("n"), part.alias("_part"))
    by_id = ["token", "id", "start"]

    def summed(table: pa.Table, keys: list[str]) -> pa.Table:
        return table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, PACK_ROWS):
            yield packed(summed(table, [*by_id, "_part"]), "_part")
            pa.default_memory_pool().release_unused()

    def of_part(table: pa.Table) -> pa.Table:
        found = summed(pa.concat_tables(list(unpacked(table.column("_rows")))), by_id)
        pa.default_memory_pool().release_unused()
        found = found.group_by(["token", "start"], use_threads=False).aggregate([("n", "max"), ([], "count_all")])
        return found.rename_columns({"n_max": "most", "count_all": "docs"}).select(["token", "start", "most", "docs"])

    fields = index.select("token", start.alias("start"), F.lit(None).cast(total).alias("most"),
                          F.lit(None).cast("long").alias("docs")).schema
    return rows.mapInArrow(pack, "_part int, _rows binary").groupBy("_part") \
        .applyInArrow(of_part, fields).withColumn("width", F.lit(range_rows))


def write_impacts(impacts: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store impacts like postings: a lookup opens the buckets of its terms. They are written first, so
    that a task runs Python for one of both steps only."""
    write_index(materialise(impacts, "impacts"), "start", path, buckets)


def read_impacts(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    return read_index(spark, path, terms)


def bounds(impacts: DataFrame, terms: list[str]) -> DataFrame:
    """``start, width, bound, docs``: no score of the range passes ``bound``; at least ``docs``
    documents of it match."""
    return impacts.filter(F.col("token").isin(folded(terms))).groupBy("start", "width").agg(
        F.sum(F.greatest("most", F.lit(0))).alias("bound"), F.max("docs").alias("docs"))


def _within(index: DataFrame, id_col: str, ranges: DataFrame) -> DataFrame:
    """Postings of some ranges. A list of them is pushed to the scan as intervals of ids, which skips
    row groups; more than ``INTERVALS`` are joined."""
    listed = ranges.select("start", "width").orderBy("start").limit(INTERVALS + 1).collect()
    if len(listed) > INTERVALS:
        width = listed[0].width
        whole = F.col(id_col).cast("long")
        placed = index.withColumn("start", whole - F.pmod(whole, F.lit(width)))
        return join_lookup(placed, ranges.select("start"), "start", "left_semi").drop("start")
    spans: list[list[int]] = []
    for start, width in listed:
        if spans and spans[-1][1] == start:
            spans[-1][1] = start + width
        else:
            spans.append([start, start + width])
    held = [(F.col(id_col) >= low) & (F.col(id_col) < high) for low, high in spans]
    return index.filter(reduce(Column.__or__, held, F.lit(False)))


def opened_ranges(index: DataFrame, impacts: DataFrame, id_col: str, terms: list[str],
                  k: int) -> DataFrame:
    """The ranges that may hold one of the ``k`` best rows."""
    # One row a range, and it is read several times.
    ranges = materialise(bounds(impacts, terms), "bounds")
    first, docs = [], 0
    for row in ranges.orderBy(F.desc("bound"), "start").limit(k).collect():
        first.append(row.start)
        docs += row.docs
        if docs >= k:
            break
    if docs < k:
        return ranges
    seeds = match_terms(_within(index, id_col, ranges.filter(F.col("start").isin(first))), id_col, terms)
    floor = seeds.orderBy(F.desc("_score")).limit(k).agg(F.min("_score")).head()[0]
    return ranges.filter(F.col("bound") >= floor)


def top_terms(index: DataFrame, impacts: DataFrame, id_col: str, terms: list[str],
              k: int) -> DataFrame:
    """``id, _score, rank`` of the ``k`` best documents that hold any of the terms; ties go to the
    smaller id. Equals sorting all of ``match_terms``. Ids are whole numbers; weights of an index
    are not negative. ``k`` is a page, up to a few thousand: that many range numbers and rows pass
    the driver or one task."""
    if k < 1:
        raise ValueError("k has to be 1 or more")
    opened = opened_ranges(index, impacts, id_col, terms, k)
    best = match_terms(_within(index, id_col, opened), id_col, terms) \
        .orderBy(F.desc("_score"), id_col).limit(k)
    # ``k`` rows sorted by the limit above are numbered in one task.
    one = best.agg(F.sort_array(F.collect_list(F.struct((-F.col("_score")).alias("s"), id_col))).alias("_rows"))
    return one.select(F.posexplode("_rows").alias("at", "row")).select(
        F.col(f"row.{id_col}").alias(id_col), (-F.col("row.s")).alias("_score"),
        (F.col("at") + 1).alias("rank"))
