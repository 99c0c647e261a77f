"""Joins and groupings that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1e-5
PART_ROWS = 1_000_000  # rows of a hot key in one task
WINDOW_LIMIT = 1000  # spark.sql.optimizer.windowGroupLimitThreshold, unless set otherwise


def _width(field: T.StructField) -> Column:
    """Bytes of a value, roughly: text by its length, nested values by their JSON form."""
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
    return F.lit(16)


def row_hash(df: DataFrame) -> Column:
    """A hash of the row's values. A task that runs again after a lost executor gets the same one,
    whatever order its input comes in; a hash of a row number would not."""
    return F.xxhash64(*[f.name for f in df.schema.fields
                        if not isinstance(f.dataType, T.MapType | T.VariantType)])


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS,
                   size: int = BROADCAST_BYTES) -> bool:
    """Size check before a broadcast: one aggregate over the columns the join would read."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    count, total = df.agg(F.count("*"), F.sum(width)).head()
    return count <= rows and (total or 0) <= size


def join_lookup(big: DataFrame, small: DataFrame, on: str, how: str = "inner",
                salts: int | None = None, broadcast: bool | None = None,
                broadcast_rows: int = BROADCAST_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """Join ``big`` with ``small``, where ``on`` may be skewed in ``big`` but not in ``small``.

    A small side of checked size is broadcast; ``broadcast`` tells the outcome of a check made
    before. Beyond that both sides are shuffled. Keys that are hot in ``big`` are dealt over as many
    salts as hold ``part_rows`` rows each, and only their rows of ``small`` are copied; all others
    have one salt. ``salts=1``, for keys unique in ``big`` too, is a plain shuffled join. ``how`` may
    be any join that preserves ``big``: inner, left, left_semi, left_anti.
    """
    if broadcast is None:
        broadcast = fits_broadcast(small, broadcast_rows)
    if broadcast:
        return big.join(F.broadcast(small), on, how)
    if salts == 1:
        return big.join(small, on, how)
    hot = hot_hashes(big, on, min_rows=part_rows).select(
        "_place", F.ceil(F.col("_rows") / part_rows).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    salted_big = _with_hot(big, hot, on) \
        .withColumn("_salt", F.pmod(row_hash(big), parts).cast("int")).drop("_parts")
    salted_small = _with_hot(small, hot, on) \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return salted_big.join(salted_small, [on, "_salt"], how).drop("_salt")


def _place(key: str) -> Column:
    # A hash of the key, null included, is small whatever the key is. Keys that share one are
    # treated alike, which changes how rows are dealt and no result.
    return F.xxhash64(F.col(key))


def hot_hashes(df: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = 0) -> DataFrame:
    """``(_place, _rows)``: hashes of keys that own more than ``share`` of the rows, and more than
    ``min_rows``: never more than 1 / ``share`` of them, however many rows there are."""
    counts = df.select(_place(key).alias("_place")).groupBy("_place") \
        .agg(F.count("*").alias("_rows"))
    floor = df.agg(F.greatest(F.count("*") * F.lit(share), F.lit(float(min_rows)))).scalar()
    return counts.filter(F.col("_rows") > floor)


def _with_hot(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``df`` with the columns of ``hot``, null for ordinary keys. ``hot`` has at most 1 / share
    rows of numbers, so it is broadcast."""
    return df.withColumn("_place", _place(key)).join(F.broadcast(hot), "_place", "left") \
        .drop("_place")


def chunk_hot_keys(df: DataFrame, key: str, order_id: Column, chunk_rows: int,
                   share: float = HOT_SHARE) -> DataFrame:
    """Add ``_chunk``: null for ordinary keys, ``order_id div chunk_rows`` for hot ones.

    (key, chunk) groups of hot keys then hold at most ``chunk_rows`` rows, as order ids are unique.
    """
    marked = _with_hot(df, hot_hashes(df, key, share, chunk_rows), key)
    chunk = F.call_function("div", order_id, F.lit(chunk_rows))
    return marked.withColumn("_chunk", F.when(F.col("_rows").isNotNull(), chunk)).drop("_rows")


def best_of_key(df: DataFrame, keys: list[str], order: list[Column], most: int,
                column: str) -> DataFrame:
    """The first ``most`` rows of every key with their place ``column``, counting from 1.

    Up to ``WINDOW_LIMIT`` rows Spark drops the rest before the shuffle. For more, hot keys are
    first cut down part by part, so no task sorts a whole hot key.
    """
    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn(column, F.row_number().over(window)).filter(F.col(column) <= most)

    if most > WINDOW_LIMIT:
        part_rows = max(PART_ROWS, most)
        owner = "_owner"
        marked = df.withColumn(owner, F.struct(*keys))
        hot = hot_hashes(marked, owner, min_rows=part_rows)
        marked = _with_hot(marked, hot, owner)
        parts = F.ceil(F.coalesce("_rows", F.lit(1)) / part_rows).cast("int")
        dealt = marked.withColumn("_part", F.pmod(row_hash(df), parts)).drop("_rows", owner)
        df = cut(dealt, [*keys, "_part"]).drop(column, "_part")
    return cut(df, keys).withColumn(column, F.col(column).cast("long"))
