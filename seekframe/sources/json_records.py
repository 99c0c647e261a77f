"""JSON record files, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.schema import ID


def read_records(spark: SparkSession, path: str, schema: T.StructType,
                 array: bool = False) -> DataFrame:
    """Records as rows: one object per line, or with ``array`` one JSON array per file.

    No inference pass; ids in the files are ignored, the load assigns them. Times are epoch seconds
    with fractions. Files with one object per line are split over tasks, arrays are not.
    """
    wanted = [f for f in schema.fields if f.name != ID]
    times = [f.name for f in wanted if isinstance(f.dataType, T.TimestampType)]
    stored = T.StructType([
        T.StructField(f.name, T.DoubleType() if f.name in times else f.dataType) for f in wanted])
    rows = spark.read.schema(stored).option("mode", "FAILFAST").option("multiLine", array).json(path)
    return rows.select(*[
        (F.timestamp_seconds(f.name) if f.name in times else F.col(f.name))
        .alias(f.name, metadata=f.metadata) for f in wanted])


def write_records(df: DataFrame, path: str) -> None:
    """Rows as records, one per line, without ids; times as epoch seconds with fractions."""
    out = [(F.unix_micros(f.name) / 1e6).alias(f.name) if isinstance(f.dataType, T.TimestampType)
           else F.col(f.name) for f in df.schema.fields if f.name != ID]
    df.select(*out).write.json(path)
