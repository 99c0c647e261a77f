"""Queries over the test tables, one or more per operator, with their SQL counterparts."""

from seekframe.plans import (  # noqa: F401  (imported to register their queries)
    aggregates,
    changes,
    filters,
    indexes,
    paging,
    streams,
    suggestions,
    texts,
)
from seekframe.plans.registry import QUERIES, SQL, Tables

__all__ = ["QUERIES", "SQL", "Tables"]
