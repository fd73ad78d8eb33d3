"""Randomised ensemble detectors (M4): INNE and isolation forest.

Both fit on small seeded samples (t samples of psi rows — sizes fixed by the
parameters, not by the data). The fitted model is a table; what it holds is
broadcast safely, and scoring is one Arrow pass over the rows, vectorised with numpy.

* INNE (Bandaragoda et al. 2018): each sample's rows are centres with radius =
  distance to the nearest fellow centre; a row falls to the smallest-radius
  centre whose ball covers it and scores 1 - r(nearest fellow of c) / r(c);
  uncovered rows score 1; the score is the mean over samples.
* Isolation forest (Liu et al. 2008): one tree per sample, grown in
  ``applyInPandas`` (one group per tree id, psi rows each) with random feature
  and split; score = 2^(-E[h(x)] / c(psi)).

Samples are drawn by a seeded hash: rows whose hash falls below a threshold
sized for about 4 psi candidates per sample, then the psi smallest hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EULER = 0.5772156649015329


def _vector(features):
    return F.array(*[F.col(c).cast("double") for c in features])


def seeded_samples(df: DataFrame, id_col: str, features: list[str], samples: int, psi: int,
                   seed: int = 7) -> DataFrame:
    """(sample_id, sid, v) with at most ``psi`` rows per sample, chosen by a seeded hash."""
    n = max(1, df.count())
    p = min(1.0, 4.0 * psi / n)
    rows = df.select(F.col(id_col).cast("string").alias("sid"), _vector(features).alias("v"))

    # per row: the samples whose seeded hash of (row, sample) falls below p — a
    # per-row expression, so each sample's candidate set (~4 psi rows) is formed
    # without joining rows to samples
    def u(sample):
        return F.pmod(F.xxhash64(F.col("sid"), sample, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda s: u(s) < p)
    cand = rows.select("sid", "v", F.explode(chosen).alias("sample_id")).withColumn("_u", u(F.col("sample_id")))
    w = Window.partitionBy("sample_id").orderBy("_u", "sid")
    return cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi).select("sample_id", "sid", "v")


# --------------------------------------------------------------------------- INNE

def _centres(pdf: pd.DataFrame) -> pd.DataFrame:
    """Radius and isolation ratio of every centre of one sample (fewer than two centres isolate nothing)."""
    c = np.stack(pdf["v"].to_numpy()).astype("float64")
    if len(c) < 2:
        return pdf.iloc[:0][["sample_id", "v"]].assign(radius=0.0, ratio=0.0)
    d = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    nn = d.argmin(1)
    radius = d[np.arange(len(c)), nn]
    return pdf[["sample_id", "v"]].assign(radius=radius, ratio=1.0 - radius[nn] / np.where(radius > 0, radius, np.inf))


def inne_table(reference: DataFrame, id_col: str, features: list[str], samples: int = 100, psi: int = 16, seed: int = 7) -> DataFrame:
    """The fitted model as rows (sample_id, v, radius, ratio): samples x psi centres."""
    centres = seeded_samples(reference, id_col, features, samples, psi, seed)
    return (centres.groupBy("sample_id").applyInPandas(_ordered(_centres), "sample_id int, v array<double>, radius double, ratio double"))


def inne_model(table: DataFrame) -> list:
    """Centres, radii and ratios per sample, for broadcasting (sizes fixed by the parameters)."""
    return [(np.stack(g["v"].to_numpy()).astype("float64"), g["radius"].to_numpy(), g["ratio"].to_numpy())
            for _, g in table.toPandas().groupby("sample_id")]


def _inne_score(model: list, x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for c, radius, ratio in model:
        d = np.sqrt(((x[:, None, :] - c[None, :, :]) ** 2).sum(2))
        cover = d <= radius[None, :]
        best = np.where(cover, radius[None, :], np.inf).argmin(1)
        total += np.where(cover.any(1), ratio[best], 1.0)
    return total / max(1, len(model))


def inne_scores(points: DataFrame, id_col: str, features: list[str], reference: DataFrame | None = None,
                samples: int = 100, psi: int = 16, seed: int = 7, ref_id_col: str | None = None) -> DataFrame:
    reference, ref_id_col = _reference(points, id_col, reference, ref_id_col)
    return score_with(_inne_score, inne_model(inne_table(reference, ref_id_col, features, samples, psi, seed)), points, id_col, features)


def _reference(points: DataFrame, id_col: str, reference: DataFrame | None, ref_id_col: str | None) -> tuple[DataFrame, str]:
    reference = points if reference is None else reference
    return reference, ref_id_col or (id_col if id_col in reference.columns else reference.columns[0])


def _ordered(fn):
    """The group's rows in a fixed order, so that a lost task fits the same again."""
    return lambda pdf: fn(pdf.sort_values("sid", kind="stable"))


def score_with(scorer, model, points: DataFrame, id_col: str, features: list[str]) -> DataFrame:
    """(id, score) by ``scorer(model, matrix)``: one Arrow pass, the model broadcast."""
    bc = points.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def run(v: pd.Series) -> pd.Series:
        return pd.Series(scorer(bc.value, np.stack(v.to_numpy()).astype("float64")) if len(v) else [], dtype="float64")

    return points.select(F.col(id_col), run(_vector(features)).alias("score"))


# --------------------------------------------------------------------------- isolation forest

def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a BST of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + _EULER) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame) -> pd.DataFrame:
    """Grow one isolation tree on a sample; returns its nodes as rows."""
    sample_id = int(pdf["sample_id"].iloc[0])
    x = np.stack(pdf["v"].to_numpy()).astype("float64")
    rng = np.random.default_rng(1_000_003 * (sample_id + 1))
    limit = math.ceil(math.log2(max(2, len(x))))
    nodes = []

    def build(idx, depth):
        node = len(nodes)
        nodes.append(None)
        sub = x[idx]
        lo, hi = sub.min(0), sub.max(0)
        splittable = np.nonzero(hi > lo)[0]
        if depth >= limit or len(idx) <= 1 or len(splittable) == 0:
            nodes[node] = (node, -1, 0.0, -1, -1, len(idx))
            return node
        f = int(rng.choice(splittable))
        s = float(rng.uniform(lo[f], hi[f]))
        left_idx, right_idx = idx[sub[:, f] < s], idx[sub[:, f] >= s]
        nodes[node] = (node, f, s, -1, -1, len(idx))
        left = build(left_idx, depth + 1)
        right = build(right_idx, depth + 1)
        nodes[node] = (node, f, s, left, right, len(idx))
        return node

    build(np.arange(len(x)), 0)
    out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size"])
    out.insert(0, "sample_id", sample_id)
    return out


def iforest_table(reference: DataFrame, id_col: str, features: list[str], trees: int = 100, psi: int = 256, seed: int = 7) -> DataFrame:
    """The fitted model as rows, one per tree node (trees x < 2 psi): one tree per seeded sample."""
    sample = seeded_samples(reference, id_col, features, trees, psi, seed)
    return sample.groupBy("sample_id").applyInPandas(
        _ordered(_grow), "sample_id long, node long, feature long, split double, left long, right long, size long")


def iforest_model(table: DataFrame) -> tuple[list, float]:
    """Trees as arrays and the average path length of a sample, for broadcasting."""
    forest, n_psi = [], 0
    for _, t in table.toPandas().groupby("sample_id"):
        t = t.sort_values("node")
        arrays = [t[c].to_numpy() for c in ("feature", "split", "left", "right")]
        arrays.append(np.array([_c(v) for v in t["size"].to_numpy()]))  # c(size) at each leaf
        forest.append(tuple(arrays))
        n_psi = max(n_psi, int(t["size"].iloc[0]))
    return forest, (_c(n_psi) or 1.0)


def fit_iforest(reference: DataFrame, id_col: str, features: list[str], trees: int = 100, psi: int = 256,
                seed: int = 7) -> tuple[list, float]:
    return iforest_model(iforest_table(reference, id_col, features, trees, psi, seed))


def _forest_score(model, x: np.ndarray) -> np.ndarray:
    trees_, cn = model
    depth_sum = np.zeros(len(x))
    for feat, split, left, right, leaf_c in trees_:
        node = np.zeros(len(x), dtype=np.int64)
        depth = np.zeros(len(x))
        active = feat[node] >= 0
        while active.any():
            f = feat[node[active]]
            go_left = x[active, f] < split[node[active]]
            node[active] = np.where(go_left, left[node[active]], right[node[active]])
            depth[active] += 1
            active = feat[node] >= 0
        depth_sum += depth + leaf_c[node]
    return np.power(2.0, -(depth_sum / max(1, len(trees_))) / cn)


def iforest_scores(points: DataFrame, id_col: str, features: list[str], reference: DataFrame | None = None,
                   trees: int = 100, psi: int = 256, seed: int = 7, ref_id_col: str | None = None) -> DataFrame:
    reference, ref_id_col = _reference(points, id_col, reference, ref_id_col)
    return score_with(_forest_score, fit_iforest(reference, ref_id_col, features, trees, psi, seed), points, id_col, features)


def model_udf(spark, model, features: list[str]):
    """K3 + D14: a fitted model as a vectorised UDF over ``struct(*features)``
    returning double (the model travels once per executor as a broadcast)."""
    bc = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def predict(packed: pd.DataFrame) -> pd.Series:
        x = packed[features].to_numpy(dtype="float64")
        return pd.Series(_forest_score(bc.value, x))

    return predict
