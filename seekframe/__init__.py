"""Full-text search, faceting, keyed tables and query-log suggestions over Spark DataFrames."""

__version__ = "0.1.0"
