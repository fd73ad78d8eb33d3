"""Raw user-behaviour log: JSON lines read under a declared nested schema (A1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

# FIXED VALUES: field names, types and order are the log's input contract (FIXTURES.md 1.1).
PARAMS_SCHEMA = StructType([
    StructField("errorCode", LongType(), True),
    StructField("itemSource", LongType(), True),
    StructField("itemType", StringType(), True),
    StructField("newpath", StringType(), True),
    StructField("oldpath", StringType(), True),
    StructField("path", StringType(), True),
    StructField("run", BooleanType(), True),
    StructField("token", StringType(), True),
    StructField("trigger", LongType(), True),
    StructField("uidOwner", StringType(), True),
    StructField("user", StringType(), True),
])

RAW_LOG_SCHEMA = StructType([
    StructField("id", LongType(), True),
    StructField("isLocalIP", BooleanType(), True),
    StructField("params", PARAMS_SCHEMA, True),
    StructField("role", StringType(), True),
    StructField("time", StringType(), True),
    StructField("type", StringType(), True),
    StructField("uid", StringType(), True),
    StructField("uidType", StringType(), True),
])

RAW_FLAT_COLUMNS = ["id", "isLocalIP", "role", "time", "type", "uid", "uidType"] + [
    f.name for f in PARAMS_SCHEMA.fields
]


def read_raw_logs(spark: SparkSession, path: str, schema: StructType = RAW_LOG_SCHEMA) -> DataFrame:
    """Scan JSON lines with a declared schema: no inference pass, missing fields null,
    a malformed line becomes an all-null row (PERMISSIVE mode)."""
    return spark.read.schema(schema).json(path)


def to_json_lines(raw: DataFrame) -> DataFrame:
    """Serialise raw-log rows back to one JSON text column ``value``."""
    return raw.select(F.to_json(F.struct(*[F.col(f.name) for f in RAW_LOG_SCHEMA.fields])).alias("value"))


def flatten_params(raw: DataFrame, struct_col: str = "params") -> DataFrame:
    """Raw columns with the nested struct spread into top-level columns."""
    cols: list[Column] = [F.col(c) for c in ["id", "isLocalIP", "role", "time", "type", "uid", "uidType"]]
    cols += [F.col(f"{struct_col}.{f.name}").alias(f.name) for f in PARAMS_SCHEMA.fields]
    return raw.select(*cols)
