"""Clustering kept over loads: the curve, files narrowed by either column, files left alone by a load."""

from __future__ import annotations

import glob
import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewise.operators import clustering as cl


@pytest.mark.parametrize("k,bits", [(1, 4), (2, 4), (3, 3)])
def test_curve_visits_every_cell_by_single_steps(k, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=k)))
    keys = cl.hilbert(cells, bits)
    assert sorted(keys) == list(range(1 << k * bits))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/{cl.PIECE}=*/*.parquet")}


def rows_of(spark, start, end):
    """Times run with the id; users do not."""
    return spark.range(start, end, 1, 4).select(
        "id", F.timestamp_seconds(F.col("id") * 60).alias("at"), F.format_string("u%03d", F.pmod(F.xxhash64("id"), F.lit(200))).alias("who"))


def test_either_column_narrows_the_files_and_a_load_leaves_others(spark, tmp_dir):
    path, df = os.path.join(tmp_dir, "t"), rows_of(spark, 0, 20_000)
    n = cl.declare_clustering(df, path, ["at", "who"], source_bytes=40 * 1024, target_bytes=1024)
    assert 30 <= n <= 40 and sorted(cl.read_clustered(spark, path).collect()) == sorted(df.collect())

    def hit(cond):
        t = spark.read.parquet(path)
        return t.where(cond).select(F.input_file_name()).distinct().count() / len(files(path))
    assert hit(F.col("who") == "u007") < 0.4                                    # 100 rows: nearly all files of a random layout
    assert hit(F.col("at") < F.timestamp_seconds(F.lit(60 * 200))) < 0.4        # 200 rows
    before = files(path)
    late = rows_of(spark, 19_900, 20_100)                                       # some known, some new, all at the end of time
    cl.load_clustered(path, late, ["id", "at", "who"])
    after = files(path)
    same = [f for f in before if after.get(f) == before[f]]
    assert len(same) > len(before) / 2 and len(after) < 2 * len(before)
    want = sorted(rows_of(spark, 0, 20_100).collect())
    assert sorted(cl.read_clustered(spark, path).collect()) == want
    cl.load_clustered(path, late, ["id", "at", "who"])
    assert sorted(cl.read_clustered(spark, path).collect()) == want


def test_nulls_ties_empty_tables_and_wrong_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    schema = "id long, x double, s string"
    df = spark.createDataFrame([(i, None if i % 3 else float("nan"), None if i % 2 else "é") for i in range(50)] + [(99, 1.0, "")], schema)
    cl.declare_clustering(df, path, ["x", "s"], source_bytes=1000, target_bytes=100)
    assert cl.read_clustered(spark, path).count() == 51
    cl.load_clustered(path, df.limit(0), ["id", "x", "s"])
    cl.load_clustered(path, spark.createDataFrame([(99, 1.0, ""), (100, -5.0, None)], schema), ["id", "x", "s"])
    assert cl.read_clustered(spark, path).count() == 52
    with pytest.raises(ValueError):
        cl.load_clustered(path, df, ["id", "x"])
    empty = os.path.join(tmp_dir, "empty")
    assert cl.declare_clustering(df.limit(0), empty, ["x", "s"], source_bytes=0) == 1


@pytest.mark.parametrize("values", [100, 254, 255, 256, 2000])
def test_ranks_fit_their_bits(spark, values):
    df = spark.range(0, values, 1, 2).select(F.format_string("w%05d", "id").alias("s"), F.col("id").cast("double").alias("x"))
    for edges in cl.rank_edges(df, ["s", "x"]):
        assert len(edges) <= (1 << cl.BITS) - 2 and edges == sorted(set(edges))
