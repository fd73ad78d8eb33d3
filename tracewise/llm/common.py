"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts lineage)."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Its cleaner follows the driver's garbage collection; an iterative job that has written
    its last round needs none of the earlier rounds' files.
    """
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def crc32_sql(list_expr: str, remainders: str = "t") -> str:
    """DuckDB expression: CRC-32 of a list of bytes, given the list of the 256 remainders."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {list_expr}), "
            f"lambda c, b: xor(c >> 8, {remainders}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")
