"""Assignment operators: the row set stays, one column takes a new value."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions import predicates as p

_RULES: dict[str, Callable[[Column, Any], Column]] = {
    "+=": lambda c, x: c + x,
    "-=": lambda c, x: c - x,
    "*=": lambda c, x: c * x,
    "/=": lambda c, x: p.divide(c, p.literal(x)),
    "%=": lambda c, x: p.modulo(c, p.literal(x)),
    "<<=": p.shift_left,
    ">>=": p.shift_right,
    "&=": lambda c, x: c.bitwiseAND(x),
    "|=": lambda c, x: c.bitwiseOR(x),
    "^=": lambda c, x: c.bitwiseXOR(x),
}


def update_column(df: DataFrame, column: str, op: str, operand: Any,
                  where: Column | None = None) -> DataFrame:
    """``column op operand`` on every row, or only on rows where ``where`` holds."""
    if op not in _RULES:
        raise ValueError(f"unknown assignment operator {op!r}")
    new = _RULES[op](F.col(column), operand)
    if where is not None:
        new = F.when(F.coalesce(where, F.lit(False)), new).otherwise(F.col(column))
    return df.withColumn(column, new)
