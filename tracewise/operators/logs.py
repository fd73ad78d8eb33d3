"""API-log aggregates, replication and pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.functions.scalar import clean_timestamp, clean_timestamp_arrow


def api_calls(logs: DataFrame, keys: list[str], name: str = "api_calls") -> DataFrame:
    """calls per key (count stays bigint, T3). Partial counts map-side."""
    return logs.groupBy(*keys).agg(F.count(F.lit(0)).alias(name))


def replicate(df: DataFrame, times: int) -> DataFrame:
    """H1: the frame repeated ``times`` times, from one scan.

    A cross join with a ``times``-row range (broadcast, size fixed by the
    argument) instead of ``times`` unions, each of which would rescan the input.
    """
    spark = df.sparkSession
    copies = F.broadcast(spark.range(times).withColumnRenamed("id", "_copy"))
    return df.crossJoin(copies).drop("_copy")


def with_clean_timestamp(logs: DataFrame, python: bool = False) -> DataFrame:
    """K1 (native expression) or K2 (Arrow-batched Python twin)."""
    fn = clean_timestamp_arrow if python else clean_timestamp
    return logs.withColumn("clean_ts", fn(F.col("timestamp_raw")))


def pivot_min(df: DataFrame, keys: list[str], pivot_col: str, values: list[str], value_col: str) -> DataFrame:
    """one column per listed value, cell = the smallest ``value_col``, and ``n_other_dates``.

    The value list is explicit (no extra job to discover it); ``min`` replaces
    ``first`` so the result does not depend on row order; rows of unlisted values are
    counted, so none vanishes.
    """
    cells = [F.min(F.when(F.col(pivot_col) == v, F.col(value_col))).alias(v) for v in values]
    other = F.count(F.when(~F.col(pivot_col).isin(*values), 1)).alias("n_other_dates")
    return df.groupBy(*keys).agg(*cells, other)
