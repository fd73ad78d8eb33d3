"""Clustering kept over loads.

``declare_clustering`` fixes, from the rows at hand, how values of the declared columns
are ranked (quantile edges) and where the Hilbert curve through the grid of ranks is
cut into pieces, and writes both beside the data. A later load puts its rows by that
rule, reads and rewrites only the pieces that its keys fall into, and leaves all other
files as they are. On the Hilbert curve neighbours differ by one rank in one column, so
a piece is narrow in every declared column and the files' own minima and maxima prune
lookups on either.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tracewise.operators.layout import DEFAULT_TARGET_BYTES, _order_value, file_count_for, string_edges
from tracewise.operators.stored import upsert_in_place

BITS = 8            # ranks per column: 2 ** BITS
PIECE = "_piece"    # partition column of a clustered table


def hilbert(ranks: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of integer ``ranks`` (n, k), all below 2 ** bits, on the Hilbert curve (Skilling 2004)."""
    x = [c.astype(np.int64) for c in ranks.T]
    k = len(x)
    if k * bits > 62:
        raise ValueError(f"{k} columns of {bits} bits do not fit a long")
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(k):
            inside = (x[i] >> b & 1).astype(bool)
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, k):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where(x[-1] >> b & 1, turn ^ ((1 << b) - 1), turn)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | (c ^ turn) >> b & 1
    return key


def _ordered(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"v{i}") if isinstance(df.schema[c].dataType, StringType) else _order_value(c, df.schema[c].dataType).alias(f"v{i}")
            for i, c in enumerate(columns)]


def _key(edges: list[list], bits: int):
    tables = [np.array(e, dtype=object if e and isinstance(e[0], str) else float) for e in edges]

    def place(values: pd.DataFrame) -> np.ndarray:
        ranks = np.zeros((len(values), len(tables)), np.int64)
        for i, table in enumerate(tables):
            known = values.iloc[:, i].notna().to_numpy()
            ranks[known, i] = np.searchsorted(table, values.iloc[:, i][known].to_numpy(), "right") + 1
        return hilbert(ranks, bits)

    return place


def hilbert_key(df: DataFrame, columns: list[str], edges: list[list], bits: int = BITS) -> Column:
    """Long: place on the curve of a row's ranks among ``edges``; nulls (and NaN) rank first."""
    place = _key(edges, bits)

    @F.pandas_udf("long")
    def key(values: pd.DataFrame) -> pd.Series:
        return pd.Series(place(values))

    return key(F.struct(*_ordered(df, columns)))


def rank_edges(df: DataFrame, columns: list[str], bits: int = BITS) -> list[list]:
    """Per column at most 2 ** bits - 2 edges (numbers and times as doubles, strings whole), so that nulls have a rank too."""
    ranks = (1 << bits) - 1
    numbers = [c for c in columns if not isinstance(df.schema[c].dataType, StringType)]
    found = {}
    if numbers:
        keyed = df.select(*[_order_value(c, df.schema[c].dataType).alias(f"v{i}") for i, c in enumerate(numbers)])
        cuts = keyed.approxQuantile([f"v{i}" for i in range(len(numbers))], [i / ranks for i in range(1, ranks)], 1 / (4 * ranks))
        found = {c: sorted({v for v in q if not math.isnan(v)}) for c, q in zip(numbers, cuts, strict=True)}
    return [found[c] if c in found else string_edges(df, c, ranks - 1) for c in columns]


def declare_clustering(df: DataFrame, path: str, columns: list[str], source_bytes: int, target_bytes: int = DEFAULT_TARGET_BYTES) -> int:
    """Write ``df`` to ``path`` clustered on ``columns``; returns the number of pieces.

    ``source_bytes`` is what the rows take as written before. A piece holds about
    ``target_bytes``; one place of the curve with more rows than that is several files.
    Rows are kept as they are, repeats included; an empty table is one empty piece.
    """
    spark, edges = df.sparkSession, rank_edges(df, columns)
    n = file_count_for(source_bytes, target_bytes)
    keyed = df.select(hilbert_key(df, columns, edges).cast("double").alias("key"))
    cuts = keyed.approxQuantile("key", [i / n for i in range(1, n)], min(0.001, 1 / (4 * n))) if n > 1 else []
    rule = {"columns": columns, "bits": BITS, "edges": edges, "cuts": sorted({int(c) for c in cuts})}
    _with_piece(df, rule).hint("rebalance", F.col(PIECE)).write.mode("overwrite").partitionBy(PIECE).parquet(path)
    spark.createDataFrame([(json.dumps(rule),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_clustering")
    return len(rule["cuts"]) + 1


def clustering_rule(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/_clustering").first()[0])


def _with_piece(df: DataFrame, rule: dict) -> DataFrame:
    place, cuts = _key(rule["edges"], rule["bits"]), np.array(rule["cuts"], np.int64)

    @F.pandas_udf("int")
    def piece(values: pd.DataFrame) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, place(values), "right"))

    return df.withColumn(PIECE, piece(F.struct(*_ordered(df, rule["columns"]))))


def load_clustered(path: str, rows: DataFrame, keys: list[str], order_by: list[str] | None = None) -> None:
    """Upsert ``rows`` by ``keys`` into the clustered table, rewriting only the pieces they fall into.

    The clustering columns must be among the keys, so that a row's piece never changes.
    The same load again changes nothing (see ``upsert_in_place``). A piece that grows
    beyond the target becomes more files; declare anew to cut the curve again.
    """
    rule = clustering_rule(rows.sparkSession, path)
    if not set(rule["columns"]) <= set(keys):
        raise ValueError(f"clustering columns {rule['columns']} must be among the keys {keys}")
    upsert_in_place(path, _with_piece(rows, rule), [*keys, PIECE], [PIECE], order_by)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PIECE)
