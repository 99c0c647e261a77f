"""The corpus pipeline: toxic and poor documents go, near copies are reduced to one, personal data
is replaced, and what is left is packed into training sequences.

Each stage takes (spark, docs, folder of the tables) and works on all that the stage before it kept.

Null and empty texts are neither toxic nor near copies of other texts: they score 0 for toxicity, get
a quality like any text, are one group of near copies together, and pack as one token. Null ids and
repeated rows are documents like others; repeated texts are near copies, so the one with the
smallest id stays, any id before null, and of equal ids one row. An empty table goes through all
stages and gives no pieces. Further columns are carried along up to the packing, whatever their
names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seekframe.llm import packing, pii, quality, simhash, toxicity
from seekframe.session import materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The classifier learns from the labelled documents of the whole corpus."""
    model = toxicity.learn(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The classifier learns from the labelled documents of the whole corpus."""
    model = quality.learn(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return quality.drop_poor(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Fingerprints of three-word shingles that differ in three bits or fewer link documents; of each
    group the one with the smallest id stays."""
    return simhash.drop_near_copies(docs, simhash.EXACT)


def redact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every span of personal data becomes its kind in angle brackets; ``n_chars`` follows."""
    return pii.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 1,024 tokens with their place in a sequence."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near copies", drop_near_copies),
          ("personal data", redact), ("packing", pack)]

#: Models, fingerprints and tokenizers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again by the next."""
    docs = _table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
