"""Anomaly scoring as Spark jobs (M2-M6, M9).

* ``train_test_split`` — reproducible hash split (no driver-side sampling).
* ``cumulative_by_value`` — distributed running totals per group in value order,
  the building block for empirical CDFs (ECOD) and rank statistics (AUC).
* ``ecod_scores`` — Li et al. (2022): tail probabilities from per-feature
  empirical CDFs, computed from (feature, value) counts.
* ``roc_auc`` — rank-sum AUC with average ranks for ties, from per-score counts.
* ``knn_scores`` — exact distance to the k-th nearest reference row (see
  ``tracewise.operators.knn``).
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 10) -> Column:
    """Deterministic bucket in [0, buckets): first 32 bits of md5(key) mod ``buckets``."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def train_test_split(frame: DataFrame, id_col: str = "id", test_buckets: int = 1, buckets: int = 10) -> DataFrame:
    """M2: ``split`` = 'test' for ``test_buckets`` of ``buckets`` hash buckets, else 'train'."""
    b = hash_bucket(F.col(id_col), buckets)
    return frame.select("*", b.alias("bucket"),
                        F.when(b < test_buckets, F.lit("test")).otherwise(F.lit("train")).alias("split"))


ROWS_PER_BLOCK = 100_000
MOST_SPLITS = 10_000       # per group: a broadcast of groups x this many numbers at most


def block_count(df: DataFrame, group_col: str) -> int:
    """Blocks per group, so that a block of the largest group holds about ROWS_PER_BLOCK rows."""
    largest = df.groupBy(group_col).count().agg(F.max("count")).first()[0] or 1
    return max(1, min(MOST_SPLITS, math.ceil(largest / ROWS_PER_BLOCK)))


def cumulative_by_value(df: DataFrame, group_col: str, value_col: str, weight_col: str,
                        blocks: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Add ``cum_le`` = sum of ``weight_col`` over rows of the same group with value <= this value.

    ``df`` must hold one row per (group, value), and few groups (a constant, the
    features). Values are cut into blocks per group by approximate percentiles (one
    aggregate, no sort); a window runs inside each (group, block) only, and block
    offsets come from a small table of groups x blocks rows. The number of blocks
    follows the number of rows, so no task ever holds a whole group; the split points
    and offsets are groups x blocks numbers (MOST_SPLITS bounds them) and broadcast.
    """
    blocks = blocks or block_count(df, group_col)
    if blocks == 1:          # no group holds more than one block's rows
        return df.withColumn("cum_le", F.sum(weight_col).over(
            Window.partitionBy(group_col).orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    probs = [i / blocks for i in range(1, blocks)]
    splits = df.groupBy(group_col).agg(F.percentile_approx(value_col, probs, max(accuracy, 20 * blocks)).alias("_splits"))
    with_block = (df.join(F.broadcast(splits), group_col)
                  .withColumn("_block", F.size(F.filter("_splits", lambda s: s < F.col(value_col))))
                  .drop("_splits"))
    w_in = (Window.partitionBy(group_col, "_block").orderBy(value_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = with_block.withColumn("_cum_in", F.sum(weight_col).over(w_in))
    totals = with_block.groupBy(group_col, "_block").agg(F.sum(weight_col).alias("_tot"))
    w_off = Window.partitionBy(group_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(w_off), F.lit(0))).drop("_tot")
    return (inner.join(F.broadcast(offsets), [group_col, "_block"])
            .withColumn("cum_le", F.col("_cum_in") + F.col("_off"))
            .drop("_block", "_cum_in", "_off"))


# --------------------------------------------------------------------------- ECOD

def ecod_scores(points: DataFrame, id_col: str, features: list[str], reference: DataFrame | None = None) -> DataFrame:
    """M4 ECOD: per feature j, left tail L = P(X_j <= x_j), right tail R = P(X_j >= x_j)
    under the empirical distribution of the reference rows (plus the scored rows
    when they are new); O_left = sum -ln L,
    O_right = sum -ln R, O_auto uses the left tail where the feature's skewness
    is negative; score = max of the three. ``reference`` defaults to ``points``.

    Rows are unpivoted to (id, feature, value); everything else works on
    distinct (feature, value) counts, so a value shared by a third of the rows
    is one row after the map-side aggregate.
    """
    points = points.checkpoint()  # read by several jobs below; cut its lineage once
    return ecod_from_counts(points, id_col, features, None if reference is None else ecod_counts(reference, features))


def _feature_values(rows: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return (rows.unpivot(keep, features, "feature", "value").filter(F.col("value").isNotNull())
            .select(*keep, "feature", F.col("value").cast("double").alias("value")))


def ecod_counts(reference: DataFrame, features: list[str]) -> DataFrame:
    """The fitted model: rows per (feature, value) of the reference."""
    return _feature_values(reference, features, []).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))


def ecod_from_counts(points: DataFrame, id_col: str, features: list[str], counts: DataFrame | None) -> DataFrame:
    """ECOD of stored ``points`` against fitted ``counts`` (None: the points themselves).

    New rows are scored against the reference and themselves, so that no tail is empty.
    """
    own = ecod_counts(points, features)
    if counts is not None:
        own = counts.unionByName(own).groupBy("feature", "value").agg(F.sum("c").alias("c"))
    ref_counts = own.checkpoint()
    pts_long = _feature_values(points, features, [id_col])
    cum = cumulative_by_value(ref_counts, "feature", "value", "c")
    sums = ref_counts.groupBy("feature").agg(F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("value")) / F.sum("c")).alias("_mean"))
    away = F.col("value") - F.col("_mean")
    stats = (ref_counts.join(F.broadcast(sums), "feature")
             .groupBy("feature", "n").agg(F.sum(F.col("c") * away * away * away).alias("skew")))      # only its sign counts
    tails = cum.join(F.broadcast(stats), "feature").select(
        "feature", "value",
        (-F.log(F.col("cum_le") / F.col("n"))).alias("u_l"),
        (-F.log((F.col("n") - F.col("cum_le") + F.col("c")) / F.col("n"))).alias("u_r"),
        F.col("skew"))
    tails = tails.withColumn("u_s", F.when(F.col("skew") < 0, F.col("u_l")).otherwise(F.col("u_r")))
    # a feature's most common value may be that of most rows: its tails are one row per
    # feature, broadcast; only the other values are joined by shuffle
    common = (ref_counts.groupBy("feature").agg(F.max(F.struct("c", "value")).alias("m"))
              .select("feature", F.col("m.value").alias("value")))
    tails = tails.join(F.broadcast(common.withColumn("_common", F.lit(True))), ["feature", "value"], "left")
    marked = pts_long.join(F.broadcast(common.withColumn("_common", F.lit(True))), ["feature", "value"], "left")
    frequent = marked.where("_common").drop("_common").join(F.broadcast(tails.where("_common").drop("_common")), ["feature", "value"])
    rare = marked.where("_common is null").drop("_common").join(tails.where("_common is null").drop("_common"), ["feature", "value"])
    per_id = frequent.unionByName(rare).groupBy(id_col).agg(
        F.sum("u_l").alias("o_left"), F.sum("u_r").alias("o_right"), F.sum("u_s").alias("o_auto"))
    return per_id.select(id_col, "o_left", "o_right", "o_auto",
                         F.greatest("o_left", "o_right", "o_auto").alias("score"))


# --------------------------------------------------------------------------- ROC AUC

def roc_auc(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """M5: area under the ROC curve = (R+ - n+(n+ + 1)/2) / (n+ n-) with average ranks.

    One row: auc, n_pos, n_neg. Works from counts per distinct score.
    """
    per = (scored.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("s"))
           .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
                F.count(F.lit(1)).alias("c"))
           .withColumn("g", F.lit(0)).checkpoint())
    cum = cumulative_by_value(per, "g", "s", "c")
    ranked = cum.withColumn("avg_rank", F.col("cum_le") - F.col("c") + (F.col("c") + 1) / 2.0)
    agg = ranked.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("r_pos"),
                     F.sum("pos").alias("n_pos"), (F.sum("c") - F.sum("pos")).alias("n_neg"))
    return agg.select(
        ((F.col("r_pos") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0)
         / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
        F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))


# --------------------------------------------------------------------------- scoring a batch

def score(features: DataFrame, id_col: str, feature_cols: list[str], reference: DataFrame, ref_id_col: str,
          detector: str = "knn", params: dict | None = None) -> DataFrame:
    """M6: one scoring entry point: (features, reference rows, detector, its parameters) -> (id, score)."""
    from tracewise.operators.ensembles import iforest_scores, inne_scores
    from tracewise.operators.knn import knn_scores
    params = params or {}
    if detector == "ecod":
        return ecod_scores(features, id_col, feature_cols, reference=reference).select(id_col, "score")
    made = {"knn": knn_scores, "inne": inne_scores, "iforest": iforest_scores}
    if detector not in made:
        raise ValueError(f"unknown detector {detector!r}")
    return made[detector](features, id_col, feature_cols, reference=reference, ref_id_col=ref_id_col, **params).select(id_col, "score")


def with_predictions(features: DataFrame, scores: DataFrame, id_col: str) -> DataFrame:
    """M6/M9: features + ``predictions`` + ``prediction_timestamp``."""
    return (features.join(scores.withColumnRenamed("score", "predictions"), id_col, "left")
            .withColumn("prediction_timestamp", F.current_timestamp()))


def normalised_ranks(scores: DataFrame, id_col: str, score_col: str = "s") -> DataFrame:
    """(id, rank in (0, 1]): average rank of the score among all rows / row count."""
    scores = scores.checkpoint()      # a detector's lazy job, read twice below
    per = (scores.filter(F.col(score_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
           .withColumn("g", F.lit(0)).checkpoint())
    cum = cumulative_by_value(per, "g", "v", "c")
    n = per.agg(F.sum("c").alias("n"))
    ranks = cum.crossJoin(F.broadcast(n)).select(
        "v", ((F.col("cum_le") - (F.col("c") - 1) / 2.0) / F.col("n")).alias("r"))
    return scores.join(ranks, scores[score_col].cast("double") == ranks["v"]).select(id_col, "r")


def ensemble_ranks(scores: dict[str, DataFrame], id_col: str) -> DataFrame:
    """P5: mean of per-detector normalised ranks (rows scored by every detector)."""
    out = None
    for name, df in scores.items():
        r = normalised_ranks(df, id_col).withColumnRenamed("r", f"r_{name}")
        out = r if out is None else out.join(r, id_col)
    cols = [F.col(f"r_{n}") for n in scores]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return out.select(id_col, (total / len(cols)).alias("ensemble_score"))


# --------------------------------------------------------------------------- model runs (M4, M5, M7, M8)

def document_features(documents: DataFrame) -> DataFrame:
    """Numeric profile of every whole document text (built-in string functions only)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    return documents.select(
        "doc_id",
        F.length(text).cast("double").alias("n_chars"),
        F.size(F.split(F.trim(text), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / n).alias("digit_frac"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / n).alias("upper_frac"),
    )


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "digit_frac", "upper_frac"]
KNN_KS = (3, 5, 10)
#: Parameter sets of the ensembles that a model search tries.
INNE_GRID = tuple({"psi": p} for p in (8, 16, 32))
IFOREST_GRID = tuple({"psi": p} for p in (64, 256))


def model_runs(features: DataFrame, labels: DataFrame, id_col: str, feature_cols: list[str], label_col: str,
               ks=KNN_KS) -> DataFrame:
    """M4 + M5: a finite candidate table (kNN for each k, ECOD), each fitted on the
    training split and scored on the labelled rows; loss = -ROC-AUC.

    One kNN run with the largest k serves every k (sorted neighbour distances).
    """
    features = features.checkpoint()  # text profiles feed every candidate; compute them once
    split = train_test_split(features, id_col)
    train = split.filter(F.col("split") == "train").select(id_col, *feature_cols)
    labelled = features.join(labels.select(id_col, label_col), id_col)
    from tracewise.operators.knn import knn_scores
    kmax = max(ks)
    knn = knn_scores(labelled.select(id_col, *feature_cols), id_col, feature_cols, reference=train,
                     ref_id_col=id_col, k=kmax, exclude_self=True, keep_distances=True)
    knn = knn.join(labelled.select(id_col, label_col), id_col).checkpoint()      # the search is lazy; every k below reads it
    runs = []
    for k in ks:
        # scores rounded to 9 decimals: ties must not depend on summation order
        scored = knn.select(F.round(F.try_element_at("distances", F.lit(k)), 9).alias("s"), label_col)
        runs.append(roc_auc(scored, "s", label_col).select(
            F.lit(f"knn_k{k}").alias("model_id"), F.lit("knn").alias("detector"),
            F.lit(f'{{"k": {k}}}').alias("params"), F.col("auc")))
    ecod = ecod_scores(labelled.select(id_col, *feature_cols), id_col, feature_cols, reference=train)
    ecod = ecod.join(labelled.select(id_col, label_col), id_col).withColumn("score", F.round("score", 9))
    runs.append(roc_auc(ecod, "score", label_col).select(
        F.lit("ecod").alias("model_id"), F.lit("ecod").alias("detector"), F.lit("{}").alias("params"),
        F.col("auc")))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.select("model_id", "detector", "params", (-F.col("auc")).alias("loss"),
                      F.when(F.col("auc").isNotNull(), F.lit("FINISHED")).otherwise(F.lit("FAILED")).alias("status"))


def select_best(runs: DataFrame) -> DataFrame:
    """The finished run with the lowest loss (ties: smallest model id)."""
    return runs.filter(F.col("status") == "FINISHED").orderBy(F.asc("loss"), F.asc("model_id")).limit(1)


def best_per_detector(runs: DataFrame) -> DataFrame:
    """P5: the finished run with the lowest loss of every detector (ties: smallest model id)."""
    done = runs.filter(F.col("status") == "FINISHED")
    rest = [c for c in runs.columns if c not in ("detector", "loss", "model_id")]
    best = done.groupBy("detector").agg(F.min(F.struct("loss", "model_id", *rest)).alias("_b"))
    return best.select(*[F.col("detector") if c == "detector" else F.col(f"_b.{c}").alias(c) for c in runs.columns])


# --------------------------------------------------------------------------- excess mass (M5, unsupervised)

def uniform_in_box(frame: DataFrame, features: list[str], n: int, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``n`` seeded uniform rows in the bounding box of ``frame`` (dimensions with
    zero range are held at their single value) and a one-row frame with the box volume
    over the dimensions that have a range."""
    box = frame.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in features],
                    *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in features])
    spark = frame.sparkSession
    rows = spark.range(n).withColumnRenamed("id", "uid").crossJoin(F.broadcast(box))
    def draw(j):   # a digest of (seed, column, row), so the rows are the same on any cluster
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(j)), F.col("uid").cast("string")))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))

    cols = [(F.col(f"lo_{c}") + draw(j) * (F.col(f"hi_{c}") - F.col(f"lo_{c}"))).alias(c)
            for j, c in enumerate(features)]
    uniform = rows.select(F.concat(F.lit("u"), F.col("uid").cast("string")).alias("uid"), *cols)
    vol = None
    for c in features:
        span = F.col(f"hi_{c}") - F.col(f"lo_{c}")
        term = F.when(span > 0, span).otherwise(F.lit(1.0))
        vol = term if vol is None else vol * term
    return uniform, box.select(vol.alias("volume"))


FAN_IN = 16                # envelopes that are merged in one task


def upper_envelope(a: np.ndarray, b: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Numbers of the lines a - b * x that are the largest at some x of the ascending ``grid`` (x >= 0).

    Those lie on the upper convex hull of the points (b, a); at most one line is kept per grid point.
    """
    order = np.lexsort((-a, b))
    higher = np.maximum.accumulate(a[order])
    order = order[np.concatenate([[True], a[order][1:] > higher[:-1]])[:len(order)]]   # steeper lines must begin higher
    x, y = b[order].tolist(), a[order].tolist()
    hull: list[int] = []
    for i in range(len(order)):
        while len(hull) > 1 and ((y[hull[-1]] - y[hull[-2]]) * (x[i] - x[hull[-2]]) <= (y[i] - y[hull[-2]]) * (x[hull[-1]] - x[hull[-2]])):
            hull.pop()
        hull.append(i)
    kept = order[hull]
    # walking down the hull's slopes, the next line wins while x is below its slope
    slopes = np.diff(a[kept]) / np.diff(b[kept])
    best = np.searchsorted(-slopes, -grid, "right")
    return kept[np.unique(best)]


def excess_mass(normal_x: DataFrame, normal_u: DataFrame, volume: DataFrame, t_steps: int = 10000,
                t_max: float = 0.9, lines_per_block: int = 100_000) -> DataFrame:
    """Area under the excess-mass curve (Goix 2016) of a normality score ``s``.

    EM(t) = max_u P(s_X > u) - t * volume * P(s_U > u) over the distinct test
    scores u, on the grid t_k = k * 0.01 / volume (k < ``t_steps``), EM(t_0) = 1;
    the area is taken up to the first t where EM(t) <= ``t_max``.
    On that grid t_k * volume = 0.01 k, so each u is one line in k. EM is the upper
    envelope of the lines: tasks reduce blocks of lines to their envelopes (at most one
    line per grid point), which merge in a tree of fan-in FAN_IN. One row: em, volume, k_max.
    """
    vals = (normal_x.select(F.col("s").alias("v"), F.lit(1).alias("cx"), F.lit(0).alias("cu"))
            .unionByName(normal_u.select(F.col("s").alias("v"), F.lit(0).alias("cx"), F.lit(1).alias("cu")))
            .groupBy("v").agg(F.sum("cx").alias("cx"), F.sum("cu").alias("cu")).withColumn("g", F.lit(0)))
    # the score columns come from detector jobs; several jobs below read them:
    # materialise the distinct scores once instead of re-running the detectors
    vals = vals.checkpoint()
    cx = cumulative_by_value(vals.select("g", "v", "cx"), "g", "v", "cx").withColumnRenamed("cum_le", "le_x")
    cu = cumulative_by_value(vals.select("g", "v", "cu"), "g", "v", "cu").withColumnRenamed("cum_le", "le_u")
    tot = vals.agg(F.sum("cx").alias("nx"), F.sum("cu").alias("nu"))
    lines = (cx.join(cu.select("v", "le_u"), "v").crossJoin(F.broadcast(tot))
             .filter(F.col("cx") > 0)
             .select(((F.col("nx") - F.col("le_x")) / F.col("nx")).alias("a"),
                     ((F.col("nu") - F.col("le_u")) / F.col("nu")).alias("b")))
    blocks = max(1, math.ceil(vals.count() / lines_per_block))
    grid = np.arange(t_steps, dtype="float64") * 0.01

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = upper_envelope(pdf["a"].to_numpy(), pdf["b"].to_numpy(), grid)
        return pdf.iloc[kept][["blk", "a", "b"]].assign(blk=pdf["blk"].iloc[0] // FAN_IN)

    parts = lines.withColumn("blk", F.pmod(F.xxhash64("a", "b"), F.lit(blocks)))
    while blocks > 1:
        parts = parts.groupBy("blk").applyInPandas(merge, "blk long, a double, b double")
        blocks = math.ceil(blocks / FAN_IN)

    def evaluate(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
        kept = upper_envelope(a, b, grid)
        best = np.full(t_steps, -np.inf)
        for s in range(0, len(kept), 512):
            some = kept[s:s + 512]
            best = np.maximum(best, (a[some, None] - b[some, None] * grid[None, :]).max(0))
        return pd.DataFrame({"k": np.arange(t_steps), "em": best})

    per_k = (parts.groupBy("blk").applyInPandas(evaluate, "k long, em double")
             .withColumn("em", F.when(F.col("k") == 0, F.lit(1.0)).otherwise(F.col("em"))))
    # the grid has t_steps rows (a parameter): ordered windows over it are bounded
    first_low = per_k.filter(F.col("em") <= t_max).agg(F.min("k").alias("k_low"))
    w = Window.orderBy("k")
    curve = (per_k.crossJoin(F.broadcast(first_low)).crossJoin(F.broadcast(volume))
             .withColumn("k_max", F.when(F.col("k_low").isNull() | (F.col("k_low") == 0), F.lit(t_steps - 1))
                         .otherwise(F.col("k_low") + 1))
             .withColumn("em_next", F.lead("em").over(w)))
    area = curve.filter(F.col("k") + 1 < F.col("k_max")).agg(
        F.sum((F.col("em") + F.col("em_next")) / 2.0 * 0.01 / F.col("volume")).alias("em"),
        F.first("volume").alias("volume"), F.first("k_max").alias("k_max"))
    return area


def evaluation_rows(split: DataFrame) -> DataFrame:
    """The test rows of a split; where the hash has put none there (few rows), the training rows."""
    test = split.filter(F.col("split") == "test")
    return test if test.take(1) else split.filter(F.col("split") == "train")


class ExcessMassTrial:
    """M4 + M5 without ground truth: fits and stores candidates and rates them by excess mass.

    Candidates are fitted on the training split and rated on the test split (the training
    rows where that is empty) against ``n_generated`` uniform rows in its bounding box.
    """

    def __init__(self, frame: DataFrame, id_col: str, features: list[str], store: str, n_generated: int = 100_000):
        split = train_test_split(frame, id_col).checkpoint()
        self.id_col, self.features, self.store = id_col, features, store.rstrip("/")
        self.train = split.filter(F.col("split") == "train").select(id_col, *features)
        self.test = evaluation_rows(split).select(id_col, *features)
        uniform, volume = uniform_in_box(self.test, features, n_generated)
        self.uniform, self.volume = uniform.checkpoint(), volume.checkpoint()

    def fit(self, model_id: str, detector: str, params: dict):
        from tracewise.operators import models
        return models.fit(self.train, self.id_col, self.features, detector, params, f"{self.store}/{model_id}")

    def rate(self, test_scores: DataFrame, uniform_scores: DataFrame) -> DataFrame:
        return excess_mass(test_scores.select((-F.col("score")).alias("s")), uniform_scores.select((-F.col("score")).alias("s")), self.volume)

    def run(self, model_id: str, detector: str, params: dict) -> DataFrame:
        """One row: model_id, detector, params, artefact, em, loss, status."""
        model = self.fit(model_id, detector, params)
        em = self.rate(model.score(self.test, self.id_col, exclude_self=True), model.score(self.uniform, "uid"))
        return self.described(em, model_id, detector, params, model.path)

    def described(self, em: DataFrame, model_id: str, detector: str, params: dict, path: str) -> DataFrame:
        return em.select(F.lit(model_id).alias("model_id"), F.lit(detector).alias("detector"), F.lit(json.dumps(params)).alias("params"),
                         F.lit(path).alias("artefact"), "em", (-F.col("em")).alias("loss"),
                         F.when(F.col("em").isNotNull(), F.lit("FINISHED")).otherwise(F.lit("FAILED")).alias("status"))


def model_runs_unlabelled(frame: DataFrame, id_col: str, features: list[str], ks=KNN_KS,
                          n_generated: int = 100_000, store: str | None = None) -> DataFrame:
    """M4 + M5 as configured in the source: a finite table of candidates (kNN for each k
    from one search, ECOD, INNE, isolation forest), loss = -excess mass; the fitted
    models are stored below ``store`` and named in ``artefact``."""
    from tracewise.session import shared_dir
    trial = ExcessMassTrial(frame, id_col, features, store or shared_dir(frame.sparkSession, "models"), n_generated)
    kmax, runs = max(ks), []
    for k in ks:
        model = trial.fit(f"knn_k{k}", "knn", {"k": k})
        if k == ks[0]:
            kt = model.distances(trial.test, id_col, kmax, exclude_self=True).checkpoint()
            ku = model.distances(trial.uniform, "uid", kmax).checkpoint()
        scores = [d.select(F.try_element_at("distances", F.lit(k)).alias("score")) for d in (kt, ku)]
        runs.append(trial.described(trial.rate(*scores), f"knn_k{k}", "knn", {"k": k}, model.path))
    runs.append(trial.run("ecod", "ecod", {}))
    for name, grid in (("inne", INNE_GRID), ("iforest", IFOREST_GRID)):
        for params in grid:
            runs.append(trial.run(f"{name}_" + "_".join(f"{k}{v}" for k, v in params.items()), name, params))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out
