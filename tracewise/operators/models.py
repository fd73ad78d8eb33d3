"""Fitted anomaly models as stored tables (M6, M8): fitted once, loaded and applied to any number of batches.

``fit`` writes what a detector has learned below a folder, ``load`` gives it back, and
``Model.score`` reads nothing but that folder and the rows to score:

* ``knn``: ``cells`` (reference vectors by cell) and ``boxes`` (their bounding boxes);
* ``ecod``: ``counts`` (rows per feature and value), from which the cumulative tails follow;
* ``inne``: ``centres`` (centre, radius and isolation ratio per sample);
* ``iforest``: ``nodes`` (one row per tree node).

The last two have a size fixed by their parameters and are broadcast; the first two grow
with the reference and stay tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.operators import anomaly as an
from tracewise.operators import ensembles as ens
from tracewise.operators import knn

TABLES = {"knn": ("cells", "boxes"), "ecod": ("counts",), "inne": ("centres",), "iforest": ("nodes",)}


class Model:
    """A loaded model: detector, parameters, features and its tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        self.detector, self.params, self.features = meta["detector"], meta["params"], meta["features"]
        self.tables = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES[self.detector]}

    def score(self, points: DataFrame, id_col: str, exclude_self: bool = False) -> DataFrame:
        """(id, score) of the rows of ``points``; higher is more anomalous.

        ``exclude_self`` (kNN only): a row that was in the reference is not its own neighbour.
        """
        if self.detector == "knn":
            return self.distances(points, id_col, self.params.get("k", 5), exclude_self).select(id_col, "score")
        if self.detector == "ecod":
            return an.ecod_from_counts(points.checkpoint(), id_col, self.features, self.tables["counts"]).select(id_col, "score")
        if self.detector == "inne":
            return ens.score_with(ens._inne_score, ens.inne_model(self.tables["centres"]), points, id_col, self.features)
        return ens.score_with(ens._forest_score, ens.iforest_model(self.tables["nodes"]), points, id_col, self.features)

    def distances(self, points: DataFrame, id_col: str, k: int, exclude_self: bool = False) -> DataFrame:
        """kNN: (id, score, distances): the k smallest distances, so that one search serves every smaller k."""
        return knn.search_cells(points.checkpoint(), id_col, self.features, self.tables["cells"], self.tables["boxes"], k=k,
                                exclude_self=exclude_self, keep_distances=True)


def fit(reference: DataFrame, id_col: str, features: list[str], detector: str, params: dict | None, path: str) -> Model:
    """Fit ``detector`` on the reference rows and store it below ``path`` (overwritten)."""
    if detector not in TABLES:
        raise ValueError(f"unknown detector {detector!r}")
    spark, params = reference.sparkSession, dict(params or {})

    def store(name: str, frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    if detector == "knn":
        cells = store("cells", knn.build_cells(reference, id_col, features))
        store("boxes", knn.cell_boxes(cells, len(features)))
    elif detector == "ecod":
        store("counts", an.ecod_counts(reference, features))
    elif detector == "inne":
        store("centres", ens.inne_table(reference, id_col, features, **params))
    else:
        store("nodes", ens.iforest_table(reference, id_col, features, **params))
    meta = json.dumps({"detector": detector, "params": params, "features": list(features)})
    spark.range(1).select(F.lit(meta).alias("value")).write.mode("overwrite").text(f"{path}/meta")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Model:
    return Model(spark, path)
