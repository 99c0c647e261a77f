"""Inverted indexes as flat postings tables: one row per token occurrence.

Postings stay flat, so a frequent token is many rows, never one huge array.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions.predicates import any_of
from seekframe.functions.tokens import Tokenizer, postings, tokens
from seekframe.operators.skew import join_lookup


def build_postings(df: DataFrame, id_col: str, columns: list[str] | dict[str, int],
                   tokenizer: str | Tokenizer = "TokenBigram", sections: bool = False,
                   weights: bool = False) -> DataFrame:
    """Postings of one or more columns: id, token, position, optional section and weight.

    ``columns`` maps names to weights, or lists names of weight 1; sections count from 1.
    """
    weighted = columns if isinstance(columns, dict) else {name: 1 for name in columns}
    parts = []
    for section, (name, weight) in enumerate(weighted.items(), 1):
        part = postings(df, id_col, name, tokenizer)
        if sections:
            part = part.withColumn("section", F.lit(section))
        if weights:
            part = part.withColumn("weight", F.lit(weight))
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def term_stats(index: DataFrame, id_col: str) -> DataFrame:
    """Per token: number of documents and of occurrences. Documents are counted in two steps, so
    the rows of a frequent token are spread by document first."""
    per_doc = index.groupBy("token", id_col).agg(F.count("*").alias("_n"))
    return per_doc.groupBy("token").agg(F.count("*").alias("df"), F.sum("_n").alias("tf"))


BUCKETS = 256
PACK_ROWS = 1 << 18  # rows that a task packs together


def _bucket(token: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(token), buckets).cast("int")


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The batches of a task in tables of about ``most`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def packed(table: pa.Table, part: str) -> pa.RecordBatch:
    """``part, _rows``: the rows of each part (its column is an int from 0 on) as one compressed value,
    sorted by ``token``: a Parquet file in memory, so a token is there once and numbers lie beside their
    like. That takes a fraction of the bytes that as many rows of a shuffle do."""
    parts = table.column(part).to_numpy().astype(np.int64)
    token = table.column("token").combine_chunks().dictionary_encode()
    code = token.indices.fill_null(len(token.dictionary)).to_numpy().astype(np.int64)
    by = np.argsort(parts << 32 | code, kind="stable")
    ends = np.flatnonzero(np.diff(parts[by], append=-1)) + 1
    sorted_rows = table.drop_columns(part).take(pa.array(by)).combine_chunks()
    whole = [f.name for f in sorted_rows.schema if pa.types.is_integer(f.type)]
    encoding = {"use_dictionary": [f.name for f in sorted_rows.schema if f.name not in whole],
                "column_encoding": dict.fromkeys(whole, "BYTE_STREAM_SPLIT")}
    values = []
    for start, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
        sink = pa.BufferOutputStream()
        pq.write_table(sorted_rows.slice(start, end - start), sink, compression="zstd", write_statistics=False,
                       store_schema=False, **encoding)
        values.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(parts[by][ends - 1], pa.int32()), pa.array(values, pa.binary())],
                                      [part, "_rows"])


def unpacked(values: pa.Array) -> Iterator[pa.Table]:
    for value in values:
        yield pq.ParquetFile(pa.BufferReader(value.as_buffer())).read(use_threads=False)


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in gathered(batches, PACK_ROWS):
        yield packed(table, "_bucket")
        pa.default_memory_pool().release_unused()


def _unpacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, table in zip(batch.column(0), unpacked(batch.column(1)), strict=True):
            placed = table.append_column("_bucket", pa.repeat(bucket, table.num_rows))
            yield from placed.to_batches(max_chunksize=PACK_ROWS // 8)
        pa.default_memory_pool().release_unused()


def write_index(index: DataFrame, id_col: str, path: str, buckets: int = BUCKETS) -> None:
    """Store postings in one folder per token bucket, sorted by (token, id).

    A lookup reads the folder of its bucket and there the row groups that hold the token. Rows are
    shuffled in packs of one bucket each. The rebalance splits a bucket that is too big for one task,
    so a frequent token covers several files; it needs no sampling pass, which would cut all texts
    twice. The number of buckets is part of the folder names, so a lookup needs no argument for it,
    and postings of new rows may be added with another number.
    """
    placed = index.withColumn("_bucket", _bucket(F.col("token"), F.lit(buckets)))
    dealt = placed.mapInArrow(_packing, "_bucket int, _rows binary").hint("rebalance", F.col("_bucket"))
    flat = dealt.mapInArrow(_unpacking, placed.schema).withColumn("_buckets", F.lit(buckets))
    flat.sortWithinPartitions("_bucket", "token", id_col) \
        .write.mode("append").partitionBy("_buckets", "_bucket").parquet(path)


def read_index(spark: SparkSession, path: str, terms: list[str] | None = None) -> DataFrame:
    """Stored postings, or only those of ``terms``: other buckets are not opened."""
    return read_tokens(spark, path, None if terms is None else folded(terms))


def read_tokens(spark: SparkSession, path: str, stored: list[str] | None) -> DataFrame:
    """As :func:`read_index`, for tokens written just as they are stored."""
    index = spark.read.parquet(path)
    if stored is not None:
        held = [F.col("_bucket") == _bucket(F.lit(t), F.col("_buckets")) for t in stored]
        index = index.filter(any_of(held) & F.col("token").isin(stored))
    return index.drop("_bucket", "_buckets")


def folded(terms: list[str]) -> list[str]:
    """Terms as tokens are stored: lower case, without blanks around, each once."""
    return list(dict.fromkeys(t.strip().lower() for t in terms))


def match_terms(index: DataFrame, id_col: str, terms: list[str],
                require_all: bool = False) -> DataFrame:
    """Documents that hold any (or all) of the tokens, with ``_score``: their occurrences, or the
    sum of weights where the index carries them. Case does not matter."""
    terms = folded(terms)
    hits = index.filter(F.col("token").isin(terms))
    amount = F.sum("weight") if "weight" in index.columns else F.count("*")
    found = hits.groupBy(id_col, "token").agg(amount.alias("_amount")).groupBy(id_col).agg(
        F.sum("_amount").cast("int").alias("_score"), F.count("*").alias("_terms"))
    if require_all:
        found = found.filter(F.col("_terms") == len(set(terms)))
    return found.drop("_terms")


def phrase_tokens(df: DataFrame, text: str, tokenizer: str | Tokenizer = "TokenBigram") -> list[str]:
    """The tokens of a short query text, by the same rules as the index."""
    return df.sparkSession.range(1).select(tokens(F.lit(text), tokenizer)).head()[0]


def _starts(index: DataFrame, id_col: str, runs: list[list[str]]) -> DataFrame:
    """Where each run of tokens starts: id, section if there is one, ``_run``, ``_start``, and its
    ``weight`` or 1.

    Every hit votes for the places where its run would start; a place with all votes is a match.
    One scan and one grouping, however many and long the runs.
    """
    places: dict[str, list[tuple[int, int]]] = {}
    for number, run in enumerate(runs):
        for at, token in enumerate(run):
            places.setdefault(token, []).append((number, at))
    votes_of = F.lit(None).cast("array<struct<run: int, at: int>>")
    for token, at in places.items():
        votes_of = F.when(F.col("token") == token, F.array(*[
            F.struct(F.lit(n).alias("run"), F.lit(a).alias("at")) for n, a in at])).otherwise(votes_of)
    section = ["section"] if "section" in index.columns else []
    weight = F.col("weight") if "weight" in index.columns else F.lit(1)
    votes = index.filter(F.col("token").isin(list(places))).select(
        id_col, *section, "position", weight.alias("weight"), F.explode(votes_of).alias("_vote"))
    start = (F.col("position") - F.col("_vote.at")).alias("_start")
    votes = votes.select(id_col, *section, F.col("_vote.run").alias("_run"), start, "weight")
    if all(len(run) == 1 for run in runs):
        return votes
    size = F.element_at(F.array(*[F.lit(len(run)) for run in runs]), F.col("_run") + 1)
    return votes.groupBy(id_col, *section, "_run", "_start").agg(
        F.count("*").alias("_votes"), F.max("weight").alias("weight")) \
        .filter(F.col("_votes") == size).drop("_votes")


def match_phrase(index: DataFrame, id_col: str, phrase: list[str]) -> DataFrame:
    """Documents where the tokens follow one another, with the number of such places, or the sum of
    their weights where the index carries them."""
    return match_phrases(index, id_col, [phrase])


def match_phrases(index: DataFrame, id_col: str, phrases: list[list[str]]) -> DataFrame:
    """Documents that hold any of the phrases, with ``_score`` over all of them."""
    return _starts(index, id_col, phrases).groupBy(id_col) \
        .agg(F.sum("weight").cast("int").alias("_score"))


def near(index: DataFrame, id_col: str, terms: list[list[str]], distance: int = 10) -> DataFrame:
    """Documents where all terms, each a run of tokens, stand within ``distance`` tokens; ``_span``
    is the smallest such distance. Only postings of the terms are read.

    One pass over the terms' places in a document, in order, carries the last place of every term;
    the span that ends at a place reaches back to the oldest of them.
    """
    terms = [list(t) for t in dict.fromkeys(map(tuple, terms)) if t]
    if not terms:
        raise ValueError("near needs at least one term")
    section = ["section"] if "section" in index.columns else []
    so_far = Window.partitionBy(id_col, *section).orderBy("_start") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(F.when(F.col("_run") == i, F.col("_start")), ignorenulls=True).over(so_far)
            for i in range(len(terms))]
    placed = _starts(index, id_col, terms).select(
        id_col, "_start", *[at.alias(f"_last{i}") for i, at in enumerate(last)])
    names = [f"_last{i}" for i in range(len(terms))]
    oldest = F.least(*names) if len(names) > 1 else F.col(names[0])
    whole = [F.col(name).isNotNull() for name in names]
    return placed.filter(reduce(Column.__and__, whole)).groupBy(id_col) \
        .agg(F.min(F.col("_start") - oldest).cast("int").alias("_span")) \
        .filter(F.col("_span") <= distance)


def _is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def reverse_refs(df: DataFrame, ref_col: str) -> DataFrame:
    """How many rows point to each key through a reference column. A row that names a key several
    times in a vector points to it once."""
    target = F.explode(F.array_distinct(ref_col)) if _is_vector(df, ref_col) else F.col(ref_col)
    return df.select(target.alias("_key")).groupBy("_key").agg(F.count("*").alias("_nsubrecs"))


def rows_pointing_to(df: DataFrame, ref_col: str, keys: DataFrame, key: str = "_key",
                     id_col: str = "_id") -> DataFrame:
    """The rows whose reference, or any entry of a vector of references, is one of ``keys``.
    ``id_col`` is read for vectors only."""
    wanted = keys.select(F.col(key).alias("_ref")).distinct()
    if not _is_vector(df, ref_col):
        return join_lookup(df.withColumn("_ref", F.col(ref_col)), wanted, "_ref", "left_semi") \
            .drop("_ref")
    entries = df.select(id_col, F.explode(F.array_distinct(ref_col)).alias("_ref"))
    hits = join_lookup(entries, wanted, "_ref", "left_semi").select(id_col).distinct()
    return join_lookup(df, hits, id_col, "left_semi", salts=1)
