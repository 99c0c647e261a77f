"""Filter predicates and arithmetic whose rules differ from Spark's plain operators.

Comparison, ``+``, ``-``, ``*``, ``&``, ``|`` and ``~`` on columns are Spark's own. Added here:
null-safe equality with a null literal, difference, division and modulo that give null on zero,
and bitwise operators that turn logical on booleans.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal(value: Any) -> Column:
    """A typed literal; naive datetimes have no time zone, as wall-clock text has none."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(T.TimestampNTZType())
    return F.lit(value)


def equals(col: Column, value: Any) -> Column:
    """Whole-value equality; a null literal matches nulls."""
    return col.isNull() if value is None else col == literal(value)


def differs(col: Column, value: Any) -> Column:
    """Whole-value inequality; a null literal matches non-nulls."""
    return col.isNotNull() if value is None else col != literal(value)


def difference(left: Column, right: Column) -> Column:
    """``left`` holds and ``right`` does not; an unknown right side counts as false."""
    return left & ~F.coalesce(right, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    """At least one holds; none of no conditions. Halved again and again, so hundreds of them do not
    nest too deep."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def divide(left: Column, right: Column) -> Column:
    """Double division, null when the divisor is zero."""
    return F.try_divide(left.cast("double"), right.cast("double"))


def modulo(left: Column, right: Column) -> Column:
    """Remainder, null when the divisor is zero."""
    return F.try_mod(left, right)


def _both_boolean(df: DataFrame, *cols: Column) -> bool:
    return all(isinstance(f.dataType, T.BooleanType) for f in df.select(*cols).schema.fields)


def bit_and(df: DataFrame, left: Column, right: Column) -> Column:
    return left & right if _both_boolean(df, left, right) else left.bitwiseAND(right)


def bit_or(df: DataFrame, left: Column, right: Column) -> Column:
    return left | right if _both_boolean(df, left, right) else left.bitwiseOR(right)


def bit_xor(df: DataFrame, left: Column, right: Column) -> Column:
    return left != right if _both_boolean(df, left, right) else left.bitwiseXOR(right)


def bit_not(df: DataFrame, col: Column) -> Column:
    return ~col if _both_boolean(df, col) else F.bitwise_not(col)


def shift_left(col: Column, bits: int | Column) -> Column:
    return F.call_function("shiftleft", col, literal(bits).cast("int"))


def shift_right(col: Column, bits: int | Column) -> Column:
    """Unsigned shift: zeros come in from the left."""
    return F.call_function("shiftrightunsigned", col, literal(bits).cast("int"))
