"""Sorting, limit, offset, slices and totals.

Sort keys are column names, ``-name`` for descending. ``tie`` names a column, or several that are
unique together, and makes the order total. Small edges of an order (the first or last rows, counted from either end) come from a
top-k; what lies beyond ``TOP_ROWS`` uses dense ranks. No plan here sends the whole table through
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.operators.rows import assign_row_id
from seekframe.operators.skew import join_lookup

TOP_ROWS = 5_000  # every task of a scan may send that many rows to one

Tie = str | list[str]


def _ties(tie: Tie | None) -> list[str]:
    return [tie] if isinstance(tie, str) else list(tie or [])


def order(keys: list[str], tie: Tie | None = "_id", reverse: bool = False) -> list[Column]:
    """Sort columns for the keys, then ``tie``; ``reverse`` flips all of them."""
    names = [(k.removeprefix("-"), k.startswith("-")) for k in keys]
    sorted_by = [name for name, _ in names]
    names += [(name, False) for name in _ties(tie) if name not in sorted_by]
    return [F.desc(name) if descending != reverse else F.asc(name) for name, descending in names]


def sort(df: DataFrame, *keys: str, tie: Tie | None = "_id", reverse: bool = False) -> DataFrame:
    return df.orderBy(*order(list(keys), tie, reverse))


def _tied(df: DataFrame, tie: Tie) -> DataFrame:
    """``df`` with its tie values as one column, so that nulls among them are values too."""
    return df.withColumn("_tie", F.struct(*_ties(tie)))


def _without(df: DataFrame, rows: DataFrame, tie: Tie) -> DataFrame:
    cut = _tied(rows, tie).select("_tie")
    return join_lookup(_tied(df, tie), cut, "_tie", "left_anti", salts=1).drop("_tie")


def _where_rank(df: DataFrame, keys: list[str], tie: Tie, inside: Column) -> DataFrame:
    """The rows whose dense ``_rank`` (from 0) is ``inside``. Only sort columns are placed and
    written; ids are unique, so the rows are found by them."""
    names = list(dict.fromkeys([*(k.removeprefix("-") for k in keys), *_ties(tie)]))
    ranks = assign_row_id(df.select(*names), order(keys, tie), column="_rank", start=0)
    kept = _tied(ranks.filter(inside), tie).select("_tie")
    return join_lookup(_tied(df, tie), kept, "_tie", "left_semi", salts=1).drop("_tie") \
        .orderBy(*order(keys, tie))


def page(df: DataFrame, keys: list[str], limit: int | None = None, offset: int = 0,
         tie: Tie = "_id", top_rows: int = TOP_ROWS) -> DataFrame:
    """Rows ``offset`` … of the order, at most ``limit`` of them.

    A negative offset counts from the end; a negative limit means ``total + limit + 1`` rows.
    """
    forward, backward = order(keys, tie), order(keys, tie, reverse=True)
    if limit == 0:
        return df.limit(0)
    if limit is not None and limit > 0 and 0 <= offset <= top_rows - limit:
        return df.orderBy(*forward).offset(offset).limit(limit)
    if limit is None and offset == 0:
        return df.orderBy(*forward)
    if limit is None and 0 < offset <= top_rows:
        return _without(df, df.orderBy(*forward).limit(offset), tie).orderBy(*forward)
    if (limit is None or limit > 0) and -top_rows <= offset < 0:
        last = df.orderBy(*backward).limit(-offset).orderBy(*forward)
        return last if limit is None else last.limit(limit)
    if limit is not None and -top_rows < limit < 0 and offset == 0:
        dropped = -limit - 1
        kept = _without(df, df.orderBy(*backward).limit(dropped), tie) if dropped else df
        return kept.orderBy(*forward)
    total = F.lit(df.count())
    start = F.lit(offset) if offset >= 0 else F.greatest(F.lit(0), total + F.lit(offset))
    inside = F.col("_rank") >= start
    if limit is not None:
        size = F.lit(limit) if limit > 0 else F.greatest(F.lit(0), total + F.lit(limit + 1))
        inside = inside & (F.col("_rank") < start + size)
    return _where_rank(df, keys, tie, inside)


def rank_page(rows: DataFrame, keys: list[str], column: str = "rank", tie: Tie = "_id") -> DataFrame:
    """Number the rows of a page from 1. For pages of bounded size: they fit in one task."""
    return rows.withColumn(column, F.row_number().over(
        Window.orderBy(*order(keys, tie))).cast("long"))


def slice_rows(df: DataFrame, keys: list[str], start: int = 0, stop: int | None = None,
               step: int = 1, tie: Tie = "_id", top_rows: int = TOP_ROWS) -> DataFrame:
    """Every ``step``-th row from ``start`` up to ``stop`` of the order (non-negative bounds)."""
    if start < 0 or step < 1 or (stop is not None and stop < 0):
        raise ValueError("slices count from the start and go forward")
    if step == 1:
        return page(df, keys, None if stop is None else max(0, stop - start), start, tie, top_rows)
    if stop is not None and stop <= top_rows:
        cut = rank_page(page(df, keys, max(0, stop - start), start, tie), keys, "_rank", tie)
        return cut.filter(F.col("_rank") % step == 1).drop("_rank").orderBy(*order(keys, tie))
    kept = (F.col("_rank") >= start) & ((F.col("_rank") - start) % step == 0)
    if stop is not None:
        kept = kept & (F.col("_rank") < stop)
    return _where_rank(df, keys, tie, kept)


def with_total(shown: DataFrame, rows: DataFrame, column: str = "all_len") -> DataFrame:
    """``shown`` plus the number of rows in the whole selection, as a scalar subquery."""
    return shown.withColumn(column, rows.agg(F.count("*")).scalar())
