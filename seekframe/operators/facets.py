"""Facets: how many records carry each value of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.operators import paging


def drilldown(df: DataFrame, column: str, id_col: str = "_id") -> DataFrame:
    """``_key``, ``_nsubrecs`` and ``_first``, the id that first shows the value.

    Counts are combined before the shuffle, so a value on a third of all rows costs one row per
    task. Sorting by ``_first`` gives the default order.
    """
    return df.groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("_nsubrecs"), F.min(id_col).alias("_first"))


def drilldown_many(df: DataFrame, columns: list[str], id_col: str = "_id") -> DataFrame:
    """Independent facets of several columns in one scan: ``facet`` names the column."""
    # Text copies under safe names: a grouping column may also be the id column.
    named = {f"_facet{i}": name for i, name in enumerate(columns)}
    texts = df.select(F.col(id_col).alias("_of"),
                      *[F.col(name).cast("string").alias(alias) for alias, name in named.items()])
    grouped = texts.groupingSets([[alias] for alias in named], *named).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_nsubrecs"),
        F.min("_of").alias("_first"))
    facet, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (alias, name) in enumerate(named.items()):
        # In a grouping id the bit of the one column grouped by is 0, all others are 1.
        mine = F.col("_set") == (1 << len(named)) - 1 - (1 << (len(named) - 1 - i))
        facet = F.when(mine, F.lit(name)).otherwise(facet)
        key = F.when(mine, F.col(alias)).otherwise(key)
    return grouped.select(facet.alias("facet"), key.alias("_key"), "_nsubrecs", "_first")


def facet_page(facets: DataFrame, sort_by: list[str] | None = None, limit: int | None = None,
               offset: int = 0, output_columns: list[str] | None = None) -> DataFrame:
    """Sort, page and project one facet; ties and the default order go by first appearance."""
    shown = paging.page(facets, sort_by or ["_first"], limit, offset, tie="_first")
    return shown.select(*output_columns) if output_columns else shown


def facet_total(facets: DataFrame) -> DataFrame:
    """Number of facet values, whatever a page of them shows."""
    return facets.agg(F.count("*").alias("all_len"))
