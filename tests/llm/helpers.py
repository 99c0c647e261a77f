"""Inputs the tests of the llm operators share."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, name, folder=FOLDER):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, rows):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""
    return spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS)
