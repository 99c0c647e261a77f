"""Selections: conditions, keyword matches, match columns, projections."""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.predicates import all_of, any_of
from seekframe.functions.text import matches, matches_any, score
from seekframe.operators import facets as fc
from seekframe.operators import paging as pg
from seekframe.operators.skew import join_lookup

if TYPE_CHECKING:
    from seekframe.sources.column_index import ColumnIndex


def select_rows(df: DataFrame, *conditions: Column, **keywords: str) -> DataFrame:
    """Rows where any condition holds and, if keywords are given, any ``column=text`` matches."""
    parts = []
    if keywords:
        parts.append(any_of([matches(F.col(c), text) for c, text in keywords.items()]))
    if conditions:
        parts.append(any_of(list(conditions)))
    return df.filter(all_of(parts)) if parts else df


def filter_rows(df: DataFrame, *conditions: Column, **keywords: str) -> DataFrame:
    """Rows where any of the conditions or keyword matches holds."""
    parts = [*conditions, *(matches(F.col(c), keywords[c]) for c in sorted(keywords))]
    return df.filter(any_of(parts)) if parts else df


def project(df: DataFrame, *columns: str, excluding: tuple[str, ...] = ()) -> DataFrame:
    """The named columns in order, all without names, minus those excluded."""
    kept = df.select(*columns) if columns else df
    return kept.drop(*excluding) if excluding else kept


@dataclass(frozen=True)
class SearchResult:
    """A page of records, the one-row total before paging (``all_len``) and facets by column."""

    page: DataFrame
    total: DataFrame
    facets: dict[str, DataFrame]


def _facet(rows: DataFrame, column: str, id_col: str, options: dict | None) -> DataFrame:
    facets = fc.drilldown(rows, column, id_col)
    return facets if options is None else fc.facet_page(facets, **options)


def search(df: DataFrame, *conditions: Column, query: str | list[str] | None = None,
           match_columns: dict[str, int] | list[str] | None = None,
           filters: list[Column] | None = None, sort_by: list[str] | None = None,
           limit: int | None = None, offset: int = 0, output_columns: list[str] | None = None,
           drilldown: list[str] | None = None, id_col: str = "_id",
           index: ColumnIndex | None = None, facet_options: dict | None = None,
           **keywords: str) -> SearchResult:
    """A whole selection in one call.

    With ``index`` the query is looked up there instead of in the texts: terms match whole runs of
    tokens, the index's columns and their weights count, and the rows are found by a join with the
    hits. ``facet_options`` (sort, offset, limit, output columns) shape the pages of the facets.

    ``query``, a text or several of which any may match, is looked for in ``match_columns`` (a
    list, or names with weights) and adds ``_score``. Conditions, query and filters all restrict the rows; facets count every selected
    row, whatever the page shows.
    """
    rows = select_rows(df, *conditions, **keywords)
    terms = [query] if isinstance(query, str) else list(query or [])
    if query is not None and index is not None:
        hits = index.search(terms).withColumnRenamed(index.id_col, id_col)
        rows = join_lookup(rows, hits, id_col, salts=1)
    elif query is not None:
        if not match_columns:
            raise ValueError("a query needs match_columns")
        weights = match_columns if isinstance(match_columns, dict) \
            else {name: 1 for name in match_columns}
        columns = [F.col(c) for c in weights]
        rows = rows.filter(any_of([matches_any(columns, term) for term in terms])) \
            .withColumn("_score", score(weights, terms))
    if filters:
        rows = filter_rows(rows, *filters)
    shown = pg.page(rows, sort_by or [id_col], limit, offset, tie=id_col)
    return SearchResult(
        page=project(shown, *(output_columns or [])),
        total=rows.agg(F.count("*").alias("all_len")),
        facets={c: _facet(rows, c, id_col, facet_options) for c in drilldown or []},
    )
