"""Hashing mode of the neighbour search: recall against all pairs, distances never too small, awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import FEATURES
from tracewise.operators.knn_hash import knn_hashed, nearest
from tracewise.plans.lake import Lake

SF = "/root/testdata/sf0.1"


def recall(vectors: np.ndarray, got: dict, k: int, base: np.ndarray | None = None) -> float:
    """Share of the true k nearest that were found (a tie with the k-th counts); found distances are true ones."""
    hits = 0
    for i, v in enumerate(vectors):
        d = np.sqrt(((v - (vectors if base is None else base)) ** 2).sum(axis=1))
        if base is None:
            d = np.delete(d, i)
        d = np.sort(d)
        found = [x["d"] for x in got[i]]
        assert all(a >= b - 1e-9 for a, b in zip(found, d, strict=False)) and found == sorted(found)
        hits += sum(x <= d[k - 1] + 1e-9 for x in found)
    return hits / (k * len(vectors))


def test_recall_on_embeddings(spark):
    """Blocks of 1/20 of the table, so that most pairs never meet in one table."""
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding is not null").orderBy("vec_id")
    table = rows.toPandas()
    v = np.stack(table["embedding"].to_numpy()).astype(float)
    points = rows.select("vec_id", "embedding")
    near = {r["vec_id"]: r["near"] for r in knn_hashed(points, "vec_id", F.col("embedding"), 5, block_rows=100, keep_neighbours=True).collect()}
    share = recall(v, [near[i] for i in table["vec_id"]], 5)
    print("embeddings", len(v), share)
    assert share >= 0.9


def test_recall_on_features(spark):
    frame = Lake(spark, SF).training_table
    vector = F.array(*[F.col(c).cast("double") for c in FEATURES])
    table = frame.select("id", vector.alias("v")).toPandas()
    v = np.stack(table["v"].to_numpy()).astype(float)
    near = {r["id"]: r["near"] for r in knn_hashed(frame, "id", vector, 5, block_rows=64, keep_neighbours=True).collect()}
    share = recall(v, [near[i] for i in table["id"]], 5)
    print("features", len(v), share)
    assert share >= 0.9


def test_one_block_is_exact_and_references_are_not_asked(spark):
    r = np.random.default_rng(1)
    a, b = r.normal(size=(40, 3)), r.normal(size=(70, 3))
    frames = [spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(t)], "id long, v array<double>") for t in (a, b)]
    rows = knn_hashed(frames[0], "id", F.col("v"), 4, reference=frames[1], keep_neighbours=True).collect()
    assert len(rows) == 40 and recall(a, {x["id"]: x["near"] for x in rows}, 4, b) == 1.0
    rows = knn_hashed(frames[1], "id", F.col("v"), 4, keep_neighbours=True).collect()
    assert recall(b, {x["id"]: x["near"] for x in rows}, 4) == 1.0


def test_awkward_rows(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [3.0, 4.0]), (3, [3.0, 4.0]), (4, None), (5, [1.0, None]), (6, [1.0, float("nan")]),
            (7, [float("inf"), 0.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted((x["id"] or 0, x["score"]) for x in knn_hashed(df, "id", F.col("v"), 1).collect())
    assert got == [(0, 1.0), (1, 0.0), (2, 0.0), (3, pytest.approx(18 ** 0.5)), (3, pytest.approx(18 ** 0.5)), (4, None), (5, None), (6, None), (7, None)]
    assert all(x["score"] is None for x in knn_hashed(df, "id", F.col("v"), 9).collect())
    assert knn_hashed(df.limit(0), "id", F.col("v"), 1).count() == 0
    pick, d = nearest(np.zeros((1, 2)), np.array([[3.0, 4.0], [0.0, 1.0]]), None, 1)
    assert pick.tolist() == [[1]] and d.tolist() == [[1.0]]
    crowd = spark.range(3000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    assert knn_hashed(crowd, "id", F.col("v"), 5, block_rows=64).where("score <> 0 or score is null").count() == 0
