"""Physical layout jobs: partitioned writes, clustering writers, file sizing and
column statistics (B4, B5, C1-C4, C6).

All user-level: a writer chooses how rows are grouped into files; Spark's
parquet reader then prunes directories (partition columns) and row groups
(min/max statistics) for pushed filters.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TARGET_BYTES = 16 * 1024 * 1024


SAMPLE_PER_RANK = 64


# --------------------------------------------------------------------------- sizing (C4)

def file_count_for(source_bytes: int, target_bytes: int = DEFAULT_TARGET_BYTES) -> int:
    """Files of about ``target_bytes`` for data that takes ``source_bytes`` as written before."""
    return max(1, math.ceil(source_bytes / target_bytes))


# --------------------------------------------------------------------------- partitioned write

def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      max_records_per_file: int | None = None) -> None:
    """Directory partitioning on low-cardinality columns.

    Rows are rebalanced on the partition columns: each task writes few directories,
    and a value that holds most of the rows is split over as many tasks as its
    measured size asks for.
    """
    w = df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.mode(mode).partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)


# --------------------------------------------------------------------------- clustering writers

def _order_value(name: str, dtype: T.DataType) -> Column:
    """An order-preserving double for ranking a numeric or time column."""
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def string_edges(df: DataFrame, name: str, ranks: int) -> list[str]:
    """Up to ``ranks`` - 1 edges that cut a string column into parts of like row counts.

    Edges are order statistics of a hash sample of the distinct values, weighted by
    their rows; whole strings are compared. The sample holds SAMPLE_PER_RANK values
    per rank at most, which bounds what the driver sees.
    """
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((r["v"], r["n"]) for r in counts.orderBy(F.xxhash64("v"), "v").limit(SAMPLE_PER_RANK * ranks).collect())
    if len(rows) <= ranks:
        return [v for v, _ in rows]
    total, seen, edges = sum(n for _, n in rows), 0, []
    for v, n in rows:
        if seen * ranks >= total * (len(edges) + 1):
            edges.append(v)
        seen += n
    return edges


def _string_rank(edges: list[str]):
    table = np.array(edges, dtype=object)

    @F.pandas_udf("int")
    def rank(values: pd.Series) -> pd.Series:
        known = values.notna().to_numpy()
        out = np.zeros(len(values), np.int32)
        out[known] = np.searchsorted(table, values[known].to_numpy(), "right") + 1
        return pd.Series(out)

    return rank


def _rank_columns(df: DataFrame, cols: list[str], bits: int, rel_error: float) -> tuple[DataFrame, list[str]]:
    """Each column -> integer rank in [0, 2^bits] from quantiles; nulls rank first.

    Numbers and times: boundaries from one ``approxQuantile`` pass (a mergeable
    sketch, not a sort) and a JVM-side binary search (``Bucketizer``). Strings: edges
    from ``string_edges`` and a binary search over whole strings, Arrow batch by batch.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [f"_rank_{i}" for i in range(len(cols))]
    text = [i for i, c in enumerate(cols) if isinstance(types[c], T.StringType)]
    other = [i for i in range(len(cols)) if i not in text]
    keyed = df.select("*", *[_order_value(cols[i], types[cols[i]]).alias(f"_ov_{i}") for i in other])
    probs = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = keyed.approxQuantile([f"_ov_{i}" for i in other], probs, rel_error) if other else []
    for i, bounds in zip(other, found, strict=True):
        splits = [-math.inf] + sorted(set(b for b in bounds if b is not None and not math.isnan(b))) + [math.inf]
        keyed = (Bucketizer(splits=splits, inputCol=f"_ov_{i}", outputCol=names[i], handleInvalid="keep")
                 .transform(keyed.fillna({f"_ov_{i}": -1.0e300})))
    for i in text:
        keyed = keyed.withColumn(names[i], _string_rank(string_edges(df, cols[i], (1 << bits) - 1))(F.col(cols[i])))
    return keyed, names


def z_value(rank_cols: list[str], bits: int) -> Column:
    """Interleave the bits of k integer ranks into one Morton key (native expression)."""
    k = len(rank_cols)
    terms = []
    for b in range(bits):
        for j, c in enumerate(rank_cols):
            bit = F.shiftright(F.col(c).cast("long"), b).bitwiseAND(F.lit(1))
            terms.append(F.shiftleft(bit, b * k + j))
    z = terms[0]
    for t in terms[1:]:
        z = z.bitwiseOR(t)
    return z


def cluster_write(df: DataFrame, path: str, cols: list[str], source_bytes: int, mode: str = "zorder",
                  target_bytes: int = DEFAULT_TARGET_BYTES, bits: int = 10, rel_error: float = 0.001,
                  partition_cols: list[str] | None = None, write_mode: str = "overwrite") -> int:
    """``df`` in files of about ``target_bytes``, clustered on ``cols``.

    ``zorder`` interleaves the columns' quantile ranks, so every column narrows the
    files read; ``range`` orders by the columns in turn. ``source_bytes`` is what the
    rows take as written before (``path_bytes`` of their table). Returns the number of
    range partitions; within a file rows are sorted by the key, so row groups are
    narrow as well.
    """
    n = file_count_for(source_bytes, target_bytes)
    original = df.columns
    if mode == "zorder":
        keyed, ranks = _rank_columns(df, cols, bits, rel_error)
        keyed = keyed.withColumn("_zkey", z_value(ranks, bits + 1))
        laid = keyed.repartitionByRange(n, "_zkey", *cols).sortWithinPartitions("_zkey", *cols).select(*original)
    elif mode == "range":
        laid = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    else:
        raise ValueError(f"unknown clustering mode {mode!r}")
    w = laid.write.mode(write_mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return n


# --------------------------------------------------------------------------- statistics

def column_statistics(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows, nulls, exact distinct count, min and max (as text).

    One aggregation pass for all columns, then an unpivot of the single result row.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [
            F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}"),
            F.count_distinct(F.col(c)).alias(f"_d{i}"),
            F.min(F.col(c)).cast("string").alias(f"_lo{i}"),
            F.max(F.col(c)).cast("string").alias(f"_hi{i}"),
        ]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("n_rows"), F.col(f"_n{i}").alias("n_nulls"),
                 F.col(f"_d{i}").alias("n_distinct"), F.col(f"_lo{i}").alias("min_value"),
                 F.col(f"_hi{i}").alias("max_value"))
        for i, c in enumerate(cols)])
    return one.select(F.inline(rows))
