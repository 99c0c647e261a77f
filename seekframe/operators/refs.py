"""Reference columns: values that are keys of another table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.operators.facets import drilldown
from seekframe.operators.rows import assign_row_id
from seekframe.operators.skew import join_lookup
from seekframe.schema import fill_defaults


def lookup(df: DataFrame, target: DataFrame, column: str, key: str,
           values: dict[str, str]) -> DataFrame:
    """Left outer lookup of ``df.column`` in ``target.key``; ``values`` maps target to new names."""
    side = target.select(F.col(key).alias(column),
                         *[F.col(name).alias(new) for name, new in values.items()])
    return join_lookup(df, side, column, "left")


def lookup_vector(df: DataFrame, target: DataFrame, id_col: str, column: str, key: str,
                  value: str, into: str) -> DataFrame:
    """Look up every entry of a vector column; order kept, missing targets give null entries."""
    entries = df.select(id_col, F.posexplode(column).alias("_at", column))
    found = lookup(entries, target, column, key, {value: "_value"})
    vectors = found.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_value"))).alias("_entries"))
    vectors = vectors.select(id_col, F.transform("_entries", lambda e: e["_value"]).alias(into))
    element = target.schema[value].dataType
    none = F.when(F.col(column).isNotNull(), F.array().cast(T.ArrayType(element)))
    return df.join(vectors, id_col, "left").withColumn(into, F.coalesce(into, none))


def drilldown_ref(df: DataFrame, column: str, target: DataFrame, key: str, value: str,
                  id_col: str = "_id") -> DataFrame:
    """Facet by a reference, with a value of the referenced row; counts first, joins after."""
    facets = drilldown(df, column, id_col)
    names = target.select(F.col(key).alias("_key"), F.col(value).alias(value))
    return facets.join(names, "_key", "left")


def missing_keys(df: DataFrame, column: str, target: DataFrame, key: str = "_key",
                 order_col: str | None = None) -> DataFrame:
    """Distinct non-null values of ``column`` that ``target`` does not have yet; ``_arrival`` is
    where each shows up first, by ``order_col`` or by the position in the scan. Entries of a vector
    count in their order."""
    place = F.col(order_col) if order_col else F.monotonically_increasing_id()
    if isinstance(df.schema[column].dataType, T.ArrayType):
        placed = df.select(place.alias("_row"), F.posexplode(column).alias("_at", key)) \
            .withColumn("_arrival", F.struct("_row", "_at"))
    else:
        placed = df.select(F.col(column).alias(key), place.alias("_arrival"))
    wanted = placed.withColumn(key, F.col(key).cast(target.schema[key].dataType)) \
        .filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("_arrival").alias("_arrival"))
    # Only the keys of the load are looked for: few of them are broadcast, and the target is scanned
    # for its key column without a shuffle.
    known = join_lookup(target.select(key), wanted.select(key), key, "left_semi", salts=1)
    return wanted.join(known, key, "left_anti")


def missing_rows(df: DataFrame, column: str, target: DataFrame, key: str = "_key",
                 id_col: str = "_id", order_col: str | None = None,
                 next_id: int | Column | None = None) -> DataFrame:
    """One row of ``target`` per missing reference, with the next ids in order of appearance and
    type defaults in all other columns."""
    missing = missing_keys(df, column, target, key, order_col)
    if next_id is None:
        next_id = F.coalesce(target.agg(F.max(id_col)).scalar(), F.lit(0)) + F.lit(1)
    rows = assign_row_id(missing, [F.col("_arrival")], id_col, next_id).drop("_arrival")
    absent = [f for f in target.schema.fields if f.name not in (key, id_col)]
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    return fill_defaults(rows, [f.name for f in absent]).select(*target.columns)


def create_missing(df: DataFrame, column: str, target: DataFrame, key: str = "_key",
                   id_col: str = "_id", order_col: str | None = None) -> DataFrame:
    """``target`` plus its :func:`missing_rows`."""
    return target.unionByName(missing_rows(df, column, target, key, id_col, order_col))
