"""An inverted index that is kept in step with its table.

Postings lie in one folder per bucket of tokens, sorted by token, and carry the generation they were
written in. A change appends the postings of the new contents and a marker ``(id, generation)`` that
voids what was posted for that record before; nothing stored is rewritten, and unchanged records are
not cut again. A lookup opens the buckets of its terms and leaves out voided postings by a join with
the markers, which are few. :meth:`ColumnIndex.compact` overwrites buckets with what is still valid
and then drops the markers.

The index is written before its table. After a lost driver the change is given again, and its new
generation voids what the lost one left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions.predicates import any_of
from seekframe.functions.tokens import Tokenizer
from seekframe.operators import index as ix
from seekframe.operators import lexicon as lx
from seekframe.operators.skew import join_lookup
from seekframe.schema import ID
from seekframe.session import materialise

BUCKET, GENERATION = "_bucket", "_generation"
BUCKETS = 64


class ColumnIndex:
    """Postings of some text columns of a table whose records have ``id_col``."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str] | dict[str, int],
                 id_col: str = ID, tokenizer: str | Tokenizer = "TokenBigram",
                 buckets: int = BUCKETS):
        """Open the index at ``path``, or start an empty one. ``columns`` maps names to weights, or
        lists names of weight 1."""
        self.spark, self.path, self.id_col, self.tokenizer = spark, path.rstrip("/"), id_col, tokenizer
        self.columns = columns if isinstance(columns, dict) else {c: 1 for c in columns}
        self.buckets = buckets
        self.schema = T.StructType([
            T.StructField("token", T.StringType()), T.StructField(id_col, T.LongType()),
            T.StructField("position", T.IntegerType()), T.StructField("section", T.IntegerType()),
            T.StructField("weight", T.IntegerType()), T.StructField(GENERATION, T.LongType()),
            T.StructField(BUCKET, T.IntegerType())])
        self.marks = T.StructType([T.StructField(id_col, T.LongType()),
                                   T.StructField(GENERATION, T.LongType())])

    def _stored(self, part: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def is_new(self) -> bool:
        """Whether nothing was ever indexed here."""
        return self._stored("generations", T.StructType([self.marks[GENERATION]])).isEmpty()

    def _generation(self) -> int:
        """Of the last change, from a folder with one number a change."""
        kind = T.StructType([self.marks[GENERATION]])
        return self._stored("generations", kind).agg(F.max(GENERATION)).head()[0] or 0

    def _bucket(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("int")

    def _write(self, postings: DataFrame, mode: str) -> None:
        placed = postings.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        placed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "token", self.id_col) \
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET) \
            .parquet(f"{self.path}/postings")

    def change(self, old: DataFrame, new: DataFrame) -> None:
        """Take over a change of some records: ``old`` and ``new`` hold their id and columns before
        and after; records that are only in ``old`` were deleted. Records that stay equal in the
        indexed columns are left as they are."""
        names = list(self.columns)
        same = reduce(Column.__and__, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
                                       for c in (self.id_col, *names)])
        new, old = new.select(self.id_col, *names), old.select(self.id_col, *names)
        changed = materialise(new.alias("new").join(old.alias("old"), same, "left_anti"), "changed")
        gone = old.select(self.id_col).join(new.select(self.id_col), self.id_col, "left_anti")
        void = materialise(changed.select(self.id_col).unionAll(gone).distinct(), "void")
        if void.isEmpty():
            return
        first, lexicon = self.is_new(), self.has_lexicon()
        generation = self._generation() + 1
        self.spark.createDataFrame([(generation,)], f"{GENERATION} long").coalesce(1) \
            .write.mode("append").parquet(f"{self.path}/generations")
        postings = ix.build_postings(changed, self.id_col, self.columns, self.tokenizer,
                                     sections=True, weights=True)
        if lexicon:  # before the postings, like the index before its table
            postings = materialise(postings, "postings")
            lx.extend_lexicon(postings, f"{self.path}/lexicon", self.buckets)
        self._write(postings.withColumn(GENERATION, F.lit(generation))
                    .withColumn(BUCKET, self._bucket(F.col("token"))), "append")
        if not first:
            void.select(F.col(self.id_col).cast("long"), F.lit(generation).cast("long").alias(GENERATION)) \
                .write.mode("append").parquet(f"{self.path}/marks")

    def _valid(self, postings: DataFrame) -> DataFrame:
        last = self._stored("marks", self.marks).groupBy(self.id_col) \
            .agg(F.max(GENERATION).alias("_void"))
        return join_lookup(postings, last, self.id_col, "left") \
            .filter(F.col("_void").isNull() | (F.col(GENERATION) >= F.col("_void"))).drop("_void")

    def postings(self, terms: list[str] | None = None) -> DataFrame:
        """Valid postings, or only those of ``terms``: other buckets are not opened."""
        return self._held(None if terms is None else ix.folded(terms))

    def _held(self, stored: list[str] | None) -> DataFrame:
        found = self._stored("postings", self.schema)
        if stored is not None:
            held = [F.col(BUCKET) == self._bucket(F.lit(t)) for t in stored]
            found = found.filter(any_of(held) & F.col("token").isin(stored))
        found = self._valid(found).drop(GENERATION, BUCKET)
        return found if len(self.columns) > 1 else found.drop("section")

    def match(self, terms: list[str], require_all: bool = False) -> DataFrame:
        """``id, _score`` of the records that hold any (or all) of the terms."""
        return ix.match_terms(self.postings(terms), self.id_col, terms, require_all)

    def _cut(self, texts: list[str]) -> list[list[str]]:
        """Each query text as tokens, by the rules of the indexed texts."""
        one = self.spark.range(1)
        return [run for run in (ix.phrase_tokens(one, t, self.tokenizer) for t in texts) if run]

    def phrase(self, text: str) -> DataFrame:
        """``id, _score`` of the records in which the tokens of ``text`` follow one another."""
        return self.search([text])

    def search(self, texts: list[str]) -> DataFrame:
        """``id, _score`` of the records that hold any of ``texts``, each as a run of tokens; scores
        count the places by the weights of their columns."""
        runs = self._cut(texts)
        found = self.postings([token for run in runs for token in run])
        return ix.match_phrases(found, self.id_col, runs or [[""]])

    def near(self, text: str, distance: int = 10) -> DataFrame:
        """``id, _span`` of the records in which all blank-separated terms of ``text`` stand within
        ``distance`` tokens of one column. No text is read."""
        runs = self._cut(text.split())
        return ix.near(self.postings([token for run in runs for token in run]), self.id_col, runs,
                       distance)

    def has_lexicon(self) -> bool:
        return bool(self._stored("lexicon/tokens", T.StructType([self.schema["token"]])).inputFiles())

    def keep_lexicon(self) -> ColumnIndex:
        """Store a lexicon of the tokens, unless there is one; every later change adds to it."""
        if not self.has_lexicon():
            lx.write_lexicon(self._stored("postings", self.schema), f"{self.path}/lexicon", self.buckets)
        return self

    def escalate(self, rows: DataFrame, term: str, threshold: int) -> DataFrame:
        """``id, _tier``: ``term`` as a whole token, as the start of one or anywhere, as strictly as
        gives more than ``threshold`` records. Needs :meth:`keep_lexicon` and an index of one column.
        ``rows`` are the table's, read only for a term that spans tokens."""
        if len(self.columns) != 1:
            raise ValueError("escalation works on an index of one column")
        return lx.match_escalation(self.spark, f"{self.path}/lexicon", self._held, rows, self.id_col,
                                   *self.columns, term, threshold, self.tokenizer)

    def compact(self, buckets: list[int] | None = None) -> None:
        """Overwrite ``buckets``, or all, with their valid postings in one sorted run each. Markers
        go when all are done. A bucket without valid postings keeps its voided ones until then."""
        stored = self._stored("postings", self.schema)
        part = stored if buckets is None else stored.filter(F.col(BUCKET).isin(buckets))
        if buckets is not None:
            self._write(self._valid(part), "overwrite")
            return
        kept = materialise(self._valid(part), "compacted")
        kept.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "token", self.id_col) \
            .write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(BUCKET).parquet(f"{self.path}/postings")
        self.spark.createDataFrame([], self.marks).write.mode("overwrite").parquet(f"{self.path}/marks")

    def clear(self) -> None:
        """Drop all postings, as for a truncated table."""
        none = self.spark.createDataFrame([], self.schema)
        none.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(BUCKET).parquet(f"{self.path}/postings")
        self.spark.createDataFrame([], self.marks).write.mode("overwrite").parquet(f"{self.path}/marks")
