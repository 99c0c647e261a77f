"""Loads, updates and deletes: each takes a snapshot of a table and gives the next one."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.operators.rows import assign_row_id
from seekframe.operators.skew import fits_broadcast, join_lookup
from seekframe.schema import ID, KEY, fill_defaults


def append(base: DataFrame, incoming: DataFrame) -> DataFrame:
    """Load into a table without key."""
    return base.unionByName(incoming, allowMissingColumns=True)


GIVEN = "_given"


def latest_by_key(incoming: DataFrame, key: str = KEY, arrival: str = "_arrival") -> DataFrame:
    """One row per key: struct ``_new`` of the last arrived values, and the first arrival.

    Where rows name in ``_given`` the columns they set, every value is that of the last row which
    sets it, and ``_given`` lists what any of them sets. Copies of a key collapse before the shuffle.
    """
    values = [c for c in incoming.columns if c not in (key, arrival, GIVEN)]
    first = F.min(arrival).alias(arrival)
    if GIVEN not in incoming.columns:
        return incoming.groupBy(key).agg(
            F.max_by(F.struct(*values), F.col(arrival)).alias("_new"), first)
    sets = lambda c: F.array_contains(GIVEN, c)
    # A struct, so a null that a row sets counts as set.
    last = [F.max_by(F.struct(c), F.when(sets(c), F.col(arrival)))[c].alias(c) for c in values]
    given = F.concat(*[F.when(F.bool_or(sets(c)), F.array(F.lit(c)))
                       .otherwise(F.array().cast("array<string>")) for c in values])
    return incoming.groupBy(key).agg(F.struct(*last).alias("_new"), given.alias(GIVEN), first)


def upsert(base: DataFrame, incoming: DataFrame, key: str = KEY, id_col: str = ID,
           arrival: str | None = None, next_id: int | Column | None = None) -> DataFrame:
    """Load by key: the last write of a key wins, known keys keep their id, new keys get the next
    ids in order of first arrival.

    ``arrival`` names a column of ``incoming`` that gives the load order (not stored); without it
    the order of the scan counts. Columns absent from ``incoming``, or from a row's ``_given``, keep
    their values; nulls in it take type defaults. ``next_id`` is for a base that is only part of its
    table; without it ids go on after the largest of ``base``.
    """
    if arrival is None:
        arrival = "_arrival"
        incoming = incoming.withColumn(arrival, F.monotonically_increasing_id())
    incoming = incoming.drop(id_col)
    given = [c for c in incoming.columns if c not in (key, arrival, GIVEN)]
    unknown = [c for c in given if c not in base.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    latest = latest_by_key(fill_defaults(incoming, given), key, arrival)
    named = GIVEN in latest.columns

    def value(c: str) -> Column:
        if c not in given:
            return F.col(c)
        new = F.array_contains(GIVEN, c) if named else F.col("_new").isNotNull()
        return F.when(new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)

    # Keys are unique on both sides; a small load is broadcast, so the table is not shuffled for it.
    small = fits_broadcast(incoming)
    updated = join_lookup(base, latest.drop(arrival), key, "left", 1, small) \
        .select(*[value(c) for c in base.columns])

    known = join_lookup(base.select(key), latest.select(key), key, "left_semi", 1, small)
    fresh = latest.join(known, key, "left_anti")
    if next_id is None:
        next_id = F.coalesce(base.agg(F.max(id_col)).scalar(), F.lit(0)) + F.lit(1)
    numbered = assign_row_id(fresh, [F.col(arrival)], id_col, next_id)
    added = numbered.select(key, id_col, *[F.col(f"_new.{c}").alias(c) for c in given])
    absent = [f for f in base.schema.fields if f.name not in added.columns]
    added = added.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    empty = [f.name for f in absent] + (given if named else [])
    return updated.unionByName(fill_defaults(added, empty))


class StagedLoad:
    """Collect batches, then load them in one go or drop them. Either ends the load."""

    def __init__(self, base: DataFrame, key: str = KEY, id_col: str = ID):
        self._base, self._key, self._id = base, key, id_col
        self._batches: list[DataFrame] | None = []

    def load(self, batch: DataFrame, arrival: str | None = None) -> StagedLoad:
        """Queue a batch; it arrives after those queued before."""
        batches = self._open()
        position = F.col(arrival) if arrival else F.monotonically_increasing_id()
        rows = batch.withColumn("_arrival", F.struct(
            F.lit(len(batches)).alias("batch"), position.alias("position")))
        batches.append(rows.drop(arrival) if arrival else rows)
        return self

    def commit(self) -> DataFrame:
        """The table after all batches."""
        rows = self.take()
        return self._base if rows is None else upsert(self._base, rows, self._key, self._id, "_arrival")

    def take(self) -> DataFrame | None:
        """End the load and give all its rows with ``_arrival``, the order they are loaded in.

        Where batches have different columns, ``_given`` names those of each row, so that a column a
        batch lacks keeps its value and one load does for all.
        """
        batches, self._batches = self._open(), None
        if not batches:
            return None
        if len({tuple(sorted(b.columns)) for b in batches}) > 1:
            batches = [b.withColumn(GIVEN, F.lit([c for c in b.columns if c not in (
                self._key, self._id, "_arrival")]).cast("array<string>")) for b in batches]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)

    def rollback(self) -> DataFrame:
        """The table as it was; nothing has been written."""
        self._open()
        self._batches = None
        return self._base

    def _open(self) -> list[DataFrame]:
        if self._batches is None:
            raise ValueError("the staged load is already committed or rolled back")
        return self._batches


def _selector(key: Any, id_: Any, where: Column | None) -> None:
    if sum(x is not None for x in (key, id_, where)) != 1:
        raise ValueError("give exactly one of key, id and where")


def _condition(key: Any, id_: Any, where: Column | None, key_col: str, id_col: str) -> Column:
    if key is not None:
        hit = F.col(key_col).isin(list(key)) if isinstance(key, list | tuple | set) \
            else F.col(key_col) == key
    elif id_ is not None:
        hit = F.col(id_col) == int(id_)
    else:
        hit = where
    return F.coalesce(hit, F.lit(False))


def delete(base: DataFrame, key: Any = None, id: Any = None, where: Column | None = None,
           key_col: str = KEY, id_col: str = ID) -> DataFrame:
    """The table without the selected rows. ``key`` is a value, a few values or a DataFrame."""
    _selector(key, id, where)
    if isinstance(key, DataFrame):
        return join_lookup(base, key.select(key_col), key_col, "left_anti", salts=1)
    return base.filter(~_condition(key, id, where, key_col, id_col))


def deletes_any(base: DataFrame, key: Any = None, id: Any = None, where: Column | None = None,
                key_col: str = KEY, id_col: str = ID) -> bool:
    """Whether :func:`delete` would take a row away; stops at the first hit."""
    return not selected(base, key, id, where, key_col, id_col).isEmpty()


def selected(base: DataFrame, key: Any = None, id: Any = None, where: Column | None = None,
             key_col: str = KEY, id_col: str = ID) -> DataFrame:
    """The rows that :func:`delete` would take away."""
    _selector(key, id, where)
    if isinstance(key, DataFrame):
        return join_lookup(base, key.select(key_col), key_col, "left_semi", salts=1)
    return base.filter(_condition(key, id, where, key_col, id_col))


def truncate(base: DataFrame) -> DataFrame:
    return base.limit(0)


def changed_rows(edited: DataFrame, stored: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of ``edited`` whose values differ from the stored row of the same key, or are new."""
    values = [c for c in edited.columns if c != key]
    old = stored.select(key, F.struct(*values).alias("_old"))
    # Only stored rows of the edited keys are compared; few edits are found without a shuffle.
    old = join_lookup(old, edited.select(key), key, "left_semi", salts=1)
    return edited.join(old, key, "left").filter(
        F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.struct(*values))).drop("_old")


def commit_changed(edited: DataFrame, stored: DataFrame, key: str = KEY,
                   id_col: str = ID) -> DataFrame:
    """The table after writing back only the rows that changed."""
    return upsert(stored, changed_rows(edited.drop(id_col), stored, key), key, id_col)
