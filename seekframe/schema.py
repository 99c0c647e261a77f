"""Declared table schemas: a type map plus field metadata for keys, vectors and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID, KEY, SCORE, COUNT = "_id", "_key", "_score", "_nsubrecs"

_GEO = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

# Declared type name -> Spark type. Unsigned types take the next wider signed one.
TYPES: dict[str, T.DataType] = {
    "Object": T.VariantType(),
    "Bool": T.BooleanType(),
    "Int8": T.ByteType(),
    "UInt8": T.ShortType(),
    "Int16": T.ShortType(),
    "UInt16": T.IntegerType(),
    "Int32": T.IntegerType(),
    "UInt32": T.LongType(),
    "Int64": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "Float": T.DoubleType(),
    "Time": T.TimestampType(),
    "ShortText": T.StringType(),
    "Text": T.StringType(),
    "LongText": T.StringType(),
    "TokyoGeoPoint": _GEO,
    "WGS84GeoPoint": _GEO,
}


@dataclass(frozen=True)
class Field:
    """One declared column. ``ref`` names the table whose key the column stores."""

    type: str = "ShortText"
    vector: bool = False
    ref: str | None = None
    last: int | None = None  # vectors only: keep the latest ``last`` values

    def spark_type(self) -> T.DataType:
        base = TYPES[self.type]
        return T.ArrayType(base) if self.vector or self.last else base


def declare(columns: dict[str, Field], key: str | None = "ShortText") -> T.StructType:
    """Schema of a table: ``_id``, ``_key`` unless ``key`` is None, then the given columns."""
    fields = [T.StructField(ID, TYPES["Int64"], True, {"pseudo": True})]
    if key is not None:
        fields.append(T.StructField(KEY, TYPES[key], True, {"key": True}))
    for name, field in columns.items():
        if name.startswith("_"):
            raise ValueError(f"column names with a leading underscore are reserved: {name}")
        metadata = {"type": field.type, "vector": field.vector or bool(field.last)}
        if field.ref:
            metadata["ref"] = field.ref
        if field.last:
            metadata["last"] = field.last
        fields.append(T.StructField(name, field.spark_type(), True, metadata))
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to ``schema``; unknown columns are an error, absent ones become null. Vectors
    declared with ``last`` keep that many of their latest values."""
    unknown = [name for name in df.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns not declared: {unknown}")
    def value(field: T.StructField) -> SparkColumn:
        given = F.col(field.name) if field.name in df.columns else F.lit(None)
        cast = given.cast(field.dataType)
        last = field.metadata.get("last")
        return cast if not last else F.when(F.size(cast) > last, F.slice(cast, -last, last)) \
            .otherwise(cast)

    return df.select(*[value(f).alias(f.name, metadata=f.metadata) for f in schema.fields])


def default_of(data_type: T.DataType) -> SparkColumn | None:
    """The value a missing entry takes: '' for text, 0 for numbers, [] for vectors, epoch for time."""
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.ArrayType):
        return F.array().cast(data_type)
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_seconds(F.lit(0))
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit("1970-01-01 00:00:00").cast(data_type)
    return None


def fill_defaults(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace nulls by type defaults in ``columns`` (all but ``_id`` and ``_key`` if not given)."""
    wanted = set(columns if columns is not None else [c for c in df.columns if c not in (ID, KEY)])
    out = []
    for field in df.schema.fields:
        default = default_of(field.dataType) if field.name in wanted else None
        out.append(F.col(field.name) if default is None
                   else F.coalesce(field.name, default).alias(field.name))
    return df.select(*out)
