"""Normalising, substring matching and occurrence scores."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seekframe.functions.predicates import any_of

# Blank characters, written so that Java and RE2 read the class alike.
BLANK = r"\x09-\x0D\x20\x85\p{Z}"


def normalise(col: Column) -> Column:
    """Lower case, blank runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(col), f"[{BLANK}]+", " "))


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFKC", s).lower(), na_action="ignore")


def normalise_nfkc(text: str | Column) -> Column:
    """Compatibility composition and lower case; Spark has no built-in for the former. Only texts
    with other than ASCII characters are sent to Python."""
    col = F.col(text) if isinstance(text, str) else text
    wide = F.octet_length(col) > F.length(col)
    return F.when(wide, _nfkc(F.when(wide, col))).otherwise(F.lower(col))


def _folded(col: Column, folded: bool) -> Column:
    return col if folded else F.lower(col)


def matches(col: Column, text: str, folded: bool = False) -> Column:
    """Case-insensitive substring match.

    ``folded=True`` says the column is stored in lower case already; the predicate then reaches
    the Parquet scan as ``StringContains``, which ``lower(col)`` would prevent.
    """
    return _folded(col, folded).contains(F.lower(F.lit(text)))


def matches_any(cols: list[Column], text: str, folded: bool = False) -> Column:
    """The text occurs in at least one of the columns."""
    return any_of([F.coalesce(matches(c, text, folded), F.lit(False)) for c in cols])


def occurrences(col: Column, text: str, folded: bool = False) -> Column:
    """Number of non-overlapping occurrences, 0 for null columns."""
    if not text:
        raise ValueError("an empty text has no occurrences")
    hay, needle = _folded(col, folded), F.lower(F.lit(text))
    removed = F.length(hay) - F.length(F.replace(hay, needle, F.lit("")))
    return F.coalesce((removed / F.length(needle)).cast("int"), F.lit(0))


def score(weights: dict[str, int], terms: list[str], folded: bool = False) -> Column:
    """Sum over columns of weight times occurrences of every term, as an integer."""
    parts = [F.lit(weight) * occurrences(F.col(name), term, folded)
             for name, weight in weights.items() for term in terms]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast("int")
