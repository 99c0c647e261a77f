"""Named tables: catalog tables over Parquet folders, one per bucket of rows.

A keyed table is dealt to buckets by a hash of its key, a table without key to blocks of record ids.
A load, a delete or a commit of changed rows works out which buckets it touches and overwrites
those (Spark's dynamic partition overwrite); the rest of the table is neither read nor written, and
loads without key only add files. The folder's own Parquet footers carry the declared schema and the
number of buckets, so any application finds the tables below the same root.

A job that fails leaves the table as it was: new files are moved in when all are written. Buckets are
moved one by one; after a driver is lost in that moment, giving the load again completes it, as loads
by key and deletes may be repeated. Two writers must not change the same table at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.operators import mutate, refs
from seekframe.operators.rows import assign_row_id
from seekframe.operators.skew import join_lookup
from seekframe.schema import ID, KEY, conform, fill_defaults
from seekframe.sources.column_index import BUCKETS as INDEX_BUCKETS
from seekframe.sources.column_index import ColumnIndex

BUCKET = "_bucket"
BUCKETS = 64  # of a keyed table, unless it is created with another number
BLOCK = 1 << 20  # record ids in a block of a table without key


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._indexes: dict[str, list[ColumnIndex]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create_all(self, schemas: dict[str, T.StructType], buckets: int = BUCKETS) -> list[str]:
        """Create the tables that do not exist yet; returns their names. Tables that another
        application left below the root are opened as they are."""
        created = []
        for name, schema in schemas.items():
            if self.spark.catalog.tableExists(name):
                continue
            stored = self._columns_of_files(name)
            if BUCKET in stored:
                # Schema, metadata and buckets come from the files.
                self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{self.path(name)}'")
            else:
                created.append(name)
                lead = KEY if KEY in schema.names else ID
                fields = [T.StructField(f.name, f.dataType, f.nullable, f.metadata | {"buckets": buckets}
                                        if f.name == lead else f.metadata) for f in schema.fields]
                empty = T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])
                # Without files there may be folders of emptied buckets left. Files of any other kind
                # are not overwritten.
                self.spark.createDataFrame([], empty).write.partitionBy(BUCKET) \
                    .mode("error" if stored else "overwrite").option("partitionOverwriteMode", "static") \
                    .option("path", self.path(name)).saveAsTable(name)
            self.spark.catalog.recoverPartitions(name)
        return created

    def _columns_of_files(self, name: str) -> list[str]:
        """Columns of the Parquet files in the table's folder; none where there is no file."""
        try:
            return self.spark.read.parquet(self.path(name)).columns
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []

    def _placed(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def scan(self, name: str) -> DataFrame:
        """The table as it is now. After a change, scan again."""
        rows = self._placed(name).drop(BUCKET)
        if KEY not in rows.columns:
            return rows
        declared = {k: v for k, v in rows.schema[KEY].metadata.items() if k != "buckets"}
        return rows.withMetadata(KEY, declared)

    def schema(self, name: str) -> T.StructType:
        return T.StructType([f for f in self._placed(name).schema.fields if f.name != BUCKET])

    def _bucket_of(self, schema: T.StructType) -> Column:
        if KEY in schema.names:
            buckets = schema[KEY].metadata["buckets"]
            return F.pmod(F.xxhash64(F.col(KEY).cast(schema[KEY].dataType)), F.lit(buckets)).cast("int")
        return F.shiftright(ID, BLOCK.bit_length() - 1).cast("int")

    def _next_id(self, name: str) -> int:
        """The largest id is in the statistics of the Parquet footers, so no column is read."""
        with _settings(self.spark, {"spark.sql.sources.useV1SourceList": "",
                                    "spark.sql.parquet.aggregatePushdown": "true"}):
            stored = self.spark.read.schema(self._placed(name).schema).parquet(self.path(name))
            return (stored.agg(F.max(ID)).head()[0] or 0) + 1

    def _touched(self, rows: DataFrame, bucket: Column) -> list[int]:
        """Buckets of some rows: never more of them than the table has."""
        return [r[0] for r in rows.select(bucket.alias(BUCKET)).distinct().collect()]

    def _write(self, name: str, rows: DataFrame, mode: str) -> None:
        schema = self.schema(name)
        placed = conform(rows.select(*schema.names), schema).withColumn(BUCKET, self._bucket_of(schema))
        # A bucket too big for one task is split by the rebalance.
        placed.hint("rebalance", F.col(BUCKET)).write.mode(mode) \
            .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path(name))
        self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)

    def _empty(self, name: str, bucket: int) -> None:
        none = self.spark.createDataFrame([], self.schema(name))
        self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BUCKET} = {bucket}) "
                       "SELECT * FROM {none}", none=none)

    def load(self, name: str, incoming: DataFrame, arrival: str | None = None) -> int:
        """Load rows: by key with last write winning, or appended to a table without key. Rows of
        referenced tables that do not exist yet are created. Returns the number of rows given.

        Only the buckets of the keys given are read and written again.
        """
        given = incoming.count()
        schema = self.schema(name)
        self._create_references(schema, incoming, arrival)
        if KEY not in schema.names:
            order = [F.col(arrival)] if arrival else None
            numbered = assign_row_id(incoming.drop(ID, mutate.GIVEN), order, ID, self._next_id(name))
            rows = fill_defaults(conform(numbered.drop(arrival) if arrival else numbered, schema))
            self._reindex(name, rows.limit(0), rows)
            self._write(name, rows, "append")
            return given
        bucket = self._bucket_of(schema)
        touched = self._touched(incoming, bucket)
        if touched:
            base = self._placed(name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
            rows = mutate.upsert(base, incoming, arrival=arrival, next_id=self._next_id(name))
            if self._indexes.get(name):
                # Of the touched buckets only the records of the keys given can differ.
                keys = incoming.select(F.col(KEY).cast(schema[KEY].dataType).alias(KEY))
                named = lambda df: join_lookup(df, keys, KEY, "left_semi", salts=1)
                self._reindex(name, named(base), named(rows))
            self._write(name, rows, "overwrite")
        return given

    def index(self, name: str, columns: list[str] | dict[str, int],
              tokenizer: str = "TokenBigram", buckets: int = INDEX_BUCKETS) -> ColumnIndex:
        """An index on columns of a table, kept in step by every later change through this store.

        An index that is there already is opened as it is, otherwise it is built from the table. An
        application that changes the table opens its indexes first.
        """
        path = f"{self.root}/{name}.index.{'.'.join(columns)}.{tokenizer}"
        index = ColumnIndex(self.spark, path, columns, ID, tokenizer, buckets)
        if index.is_new():
            index.change(self.scan(name).limit(0), self.scan(name))
        self._indexes.setdefault(name, []).append(index)
        return index

    def _reindex(self, name: str, old: DataFrame, new: DataFrame) -> None:
        for index in self._indexes.get(name, []):
            index.change(old, new)

    def _create_references(self, schema: T.StructType, incoming: DataFrame,
                           arrival: str | None) -> None:
        for field in schema.fields:
            ref = field.metadata.get("ref")
            if ref is None or field.name not in incoming.columns \
                    or not self.spark.catalog.tableExists(ref):
                continue
            target = self.scan(ref)
            if KEY in target.columns:
                # Appended: rows that the table has already are not rewritten.
                rows = refs.missing_rows(incoming, field.name, target, order_col=arrival,
                                         next_id=self._next_id(ref))
                self._reindex(ref, rows.limit(0), rows)
                self._write(ref, rows, "append")

    def staged(self, name: str) -> StagedTableLoad:
        return StagedTableLoad(self, name)

    def delete(self, name: str, key: Any = None, id: Any = None,
               where: Column | None = None) -> bool:
        """Delete by exactly one selector; True if a row went away. Only buckets that hold a
        selected row are written again; a key or, without key column, an id names its bucket."""
        placed, schema = self._placed(name), self.schema(name)
        hits = mutate.selected(self._narrowed(placed, schema, key, id), key, id, where)
        touched = self._touched(hits, F.col(BUCKET))
        if not touched:
            return False
        base = placed.filter(F.col(BUCKET).isin(touched))
        if self._indexes.get(name):
            gone = mutate.selected(base, key, id, where)
            self._reindex(name, gone, gone.limit(0))
        left = mutate.delete(base, key, id, where)
        kept = set(self._touched(left, F.col(BUCKET)))
        if kept:
            self._write(name, left.filter(F.col(BUCKET).isin(list(kept))).drop(BUCKET), "overwrite")
        for bucket in set(touched) - kept:
            self._empty(name, bucket)
        return True

    def _narrowed(self, placed: DataFrame, schema: T.StructType, key: Any, id_: Any) -> DataFrame:
        """The buckets that a literal key or id can be in; all, where the selector does not tell."""
        if id_ is not None and KEY not in schema.names:
            return placed.filter(F.col(BUCKET) == int(id_) >> (BLOCK.bit_length() - 1))
        if key is None or KEY not in schema.names:
            return placed
        kind = schema[KEY].dataType
        if isinstance(key, DataFrame):
            keys = key.select(F.col(KEY).cast(kind).alias(KEY))
        else:
            keys = self.spark.createDataFrame(
                [(k,) for k in (key if isinstance(key, list | tuple | set) else [key])],
                T.StructType([T.StructField(KEY, kind)]))
        return placed.filter(F.col(BUCKET).isin(self._touched(keys, self._bucket_of(schema))))

    def truncate(self, name: str) -> None:
        """Empty one table. Other tables, also those that refer to it, stay as they are."""
        for index in self._indexes.get(name, []):
            index.clear()
        self._placed(name).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(BUCKET).parquet(self.path(name))
        self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)

    def commit_changed(self, name: str, edited: DataFrame) -> int:
        """Write back the rows of ``edited`` that differ from the table; 0 writes nothing."""
        changed = mutate.changed_rows(edited.drop(ID), self.scan(name))
        count = changed.count()
        if count:
            self.load(name, changed)
        return count


class StagedTableLoad:
    """Batches queued for one table; nothing is written before :meth:`commit`."""

    def __init__(self, store: TableStore, name: str):
        self._store, self._name = store, name
        self._load = mutate.StagedLoad(store.scan(name))

    def load(self, batch: DataFrame, arrival: str | None = None) -> StagedTableLoad:
        self._load.load(batch, arrival)
        return self

    def commit(self) -> int:
        """Load all batches into the table as it is now, in one go; returns the rows given."""
        rows = self._load.take()
        return 0 if rows is None else self._store.load(self._name, rows, arrival="_arrival")

    def rollback(self) -> None:
        self._load.rollback()
