"""Column expressions used across the pipeline (all JVM-side, codegen friendly)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewise.functions.vocabulary import API_TS_IN, API_TS_OUT, FOLDER_PREFIX


def prefixed(prefix: str, c: Column | str) -> Column:
    """``prefix || c`` with SQL null propagation (null in -> null out)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


def status_of(error_code: Column) -> Column:
    """'success' when the error code is null or 200, else 'failed'."""
    return F.when(error_code.isNull() | (error_code == 200), F.lit("success")).otherwise(F.lit("failed"))


def root_segment(path: Column) -> Column:
    """First path segment; the second one when the path starts with '/'.

    Uses ``get`` (null when out of range) so ANSI mode never raises.
    """
    parts = F.split(path, "/")
    first = F.get(parts, 0)
    return F.when(F.length(first) < 1, F.get(parts, 1)).otherwise(first)


def root_folder_id(path: Column) -> Column:
    return F.concat(F.lit(FOLDER_PREFIX), root_segment(path))


def clean_timestamp(raw: Column) -> Column:
    """``[dd/MMM/yyyy:HH:mm:ss`` -> ``yyyy-MM-ddTHH:mm:ss`` (UTC wall clock).

    Native expression; unparseable text gives null instead of failing.
    """
    text = F.replace(raw, F.lit("["), F.lit(""))
    return F.date_format(F.try_to_timestamp(text, F.lit(API_TS_IN)), API_TS_OUT)


def register_sql_functions(spark: SparkSession) -> None:
    """Named SQL function ``cleanTimestamp`` backed by a native expression."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cleanTimestamp(raw_ts STRING) RETURNS STRING "
        f"RETURN date_format(try_to_timestamp(replace(raw_ts, '[', ''), '{API_TS_IN}'), \"{API_TS_OUT}\")"
    )


@F.pandas_udf(T.StringType())
def clean_timestamp_arrow(raw: pd.Series) -> pd.Series:
    """Vectorised Python twin of :func:`clean_timestamp`, kept for comparison only."""
    text = raw.str.replace("[", "", regex=False)
    parsed = pd.to_datetime(text, format="%d/%b/%Y:%H:%M:%S", errors="coerce")
    out = parsed.dt.strftime("%Y-%m-%dT%H:%M:%S")
    return out.where(parsed.notna(), None)
