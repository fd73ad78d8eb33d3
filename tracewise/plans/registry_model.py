"""Anomaly-model queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tracewise.functions.vocabulary import FEATURES
from tracewise.operators import anomaly as an
from tracewise.operators import graph as gr
from tracewise.operators import models
from tracewise.operators import search as srch
from tracewise.operators.knn import knn_scores
from tracewise.operators.knn_hash import knn_hashed
from tracewise.operators.model_registry import ModelRegistry
from tracewise.operators.upsert import upsert
from tracewise.plans.catalog import query
from tracewise.plans.lake import Lake
from tracewise.plans.oracle_sql import LOGINS, with_ctes
from tracewise.session import path_exists, shared_dir
from tracewise.streaming import partials as part

FEATS = list(FEATURES)
K = 5
BUCKET_SQL = "CAST(('0x' || substr(md5(id), 1, 8)) AS BIGINT) % 10"
SPLIT_CTE = ("split", f"SELECT *, {BUCKET_SQL} AS bucket, CASE WHEN {BUCKET_SQL} < 1 THEN 'test' ELSE 'train' END "
                      "AS split FROM training_frame")
TRAIN_CTE = ("train", "SELECT * FROM split WHERE split = 'train'")


def _train(lake: Lake):
    return an.train_test_split(lake.training_table, "id").filter(F.col("split") == "train").drop("bucket", "split")


@query("train_test_split", with_ctes("SELECT * FROM split", "training_frame", extra=[SPLIT_CTE]))
def q_train_test_split(spark, sf_dir):
    """M2: reproducible 90/10 hash split of the training frame."""
    return an.train_test_split(Lake(spark, sf_dir).training_frame, "id")


def _knn_sql(points: str, ref: str, pid: str, exclude_self: bool) -> str:
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS)
    cond = "a.id <> b.id" if exclude_self else "TRUE"
    return (f"SELECT a.{pid} AS qid, sqrt({dist}) AS d FROM {points} a JOIN {ref} b ON {cond}")


_KNN_SCORE_SQL = with_ctes(
    f"SELECT qid AS id, ROUND(d, 6) AS score FROM (SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) rn "
    f"FROM pairs) t WHERE rn = {K}", "training_frame",
    extra=[SPLIT_CTE, TRAIN_CTE, ("pairs", _knn_sql("train", "train", "id", True))])


@query("knn_anomaly_score", _KNN_SCORE_SQL)
def q_knn_anomaly_score(spark, sf_dir):
    """M3: distance to the 5th nearest other training row (exact)."""
    tr = _train(Lake(spark, sf_dir))
    return knn_scores(tr, "id", FEATS, k=K).select("id", F.round("score", 6).alias("score"))


@query("knn_hashed_score", _KNN_SCORE_SQL)
def q_knn_hashed_score(spark, sf_dir):
    """M3 by random projections: equal to the exact score while all rows fit one block, at least 0.9 of the neighbours beyond."""
    tr = _train(Lake(spark, sf_dir))
    vector = F.array(*[F.col(c).cast("double") for c in FEATS])
    return knn_hashed(tr, "id", vector, K).select("id", F.round("score", 6).alias("score"))


_ECOD_EXTRA = [
    ("long", "SELECT id, feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT training_frame ON "
             + ", ".join(FEATS) + " INTO NAME feature VALUE value)"),
    ("cnt", "SELECT feature, value, COUNT(*) AS c FROM long GROUP BY feature, value"),
    ("cum", "SELECT feature, value, c, SUM(c) OVER (PARTITION BY feature ORDER BY value) AS cum_le, "
            "SUM(c) OVER (PARTITION BY feature) AS n FROM cnt"),
    ("sk", "SELECT feature, skewness(value) AS skew FROM long GROUP BY feature"),
    ("tails", "SELECT cum.feature, value, -ln(cum_le / n) AS u_l, -ln((n - cum_le + c) / n) AS u_r, "
              "CASE WHEN skew < 0 THEN -ln(cum_le / n) ELSE -ln((n - cum_le + c) / n) END AS u_s "
              "FROM cum JOIN sk ON cum.feature = sk.feature"),
]


@query("ecod_score", with_ctes(
    "SELECT id, ROUND(SUM(u_l), 6) AS o_left, ROUND(SUM(u_r), 6) AS o_right, ROUND(SUM(u_s), 6) AS o_auto, "
    "ROUND(GREATEST(SUM(u_l), SUM(u_r), SUM(u_s)), 6) AS score FROM long JOIN tails USING (feature, value) GROUP BY id",
    "training_frame", extra=_ECOD_EXTRA))
def q_ecod_score(spark, sf_dir):
    """M4 ECOD over the 12 features of every user."""
    s = an.ecod_scores(Lake(spark, sf_dir).training_table, "id", FEATS)
    return s.select("id", *[F.round(c, 6).alias(c) for c in ["o_left", "o_right", "o_auto", "score"]])


@query("roc_auc", """
WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS s, l.toxic AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           WHERE d.n_chars IS NOT NULL AND l.toxic IS NOT NULL),
g AS (SELECT s, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, COUNT(*) AS c FROM s GROUP BY s),
r AS (SELECT *, SUM(c) OVER (ORDER BY s) - c + (c + 1) / 2.0 AS avg_rank FROM g)
SELECT ROUND((SUM(pos * avg_rank) - SUM(pos) * (SUM(pos) + 1) / 2.0) / (SUM(pos) * (SUM(c) - SUM(pos))), 6) AS auc,
  CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(c) - SUM(pos) AS BIGINT) AS n_neg FROM r""")
def q_roc_auc(spark, sf_dir):
    """M5: ROC-AUC of a score against ground truth (document length vs the toxic label)."""
    lake = Lake(spark, sf_dir)
    scored = lake.table("documents").select("doc_id", "n_chars").join(
        lake.table("labels").select("doc_id", "toxic"), "doc_id")
    return an.roc_auc(scored, "n_chars", "toxic").select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


def _knn_model(lake: Lake) -> models.Model:
    """The kNN model of the training rows, fitted and stored once."""
    path = f"{lake.folder}/models/knn"
    if not path_exists(lake.spark, f"{path}/meta/_SUCCESS"):
        models.fit(_train(lake), "id", FEATS, "knn", {"k": K}, path)
    return models.load(lake.spark, path)


def _batch_scores(lake: Lake):
    return _knn_model(lake).score(lake.rolling_table, "user_id")


@query("score_active_batch", with_ctes(
    f"SELECT qid AS user_id, ROUND(d, 6) AS score FROM (SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) rn "
    f"FROM pairs) t WHERE rn = {K}", "training_frame", "rolling_frame",
    extra=[SPLIT_CTE, TRAIN_CTE, ("pairs", _knn_sql("rolling_frame", "train", "user_id", False))]))
def q_score_active_batch(spark, sf_dir):
    """M6: the active batch's rolling features scored against the training rows (kNN)."""
    return _batch_scores(Lake(spark, sf_dir)).select("user_id", F.round("score", 6).alias("score"))


@query("anomaly_predictions", with_ctes(
    "SELECT f.*, ROUND(s.d, 6) AS predictions FROM rolling_frame f LEFT JOIN "
    f"(SELECT qid, d FROM (SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) rn FROM pairs) t "
    f"WHERE rn = {K}) s ON s.qid = f.user_id", "training_frame", "rolling_frame",
    extra=[SPLIT_CTE, TRAIN_CTE, ("pairs", _knn_sql("rolling_frame", "train", "user_id", False))]))
def q_anomaly_predictions(spark, sf_dir):
    """M9 + D12 + D14: features + predictions + prediction_timestamp, overwritten as a table
    and read back (the timestamp is checked separately, not compared)."""
    lake = Lake(spark, sf_dir)
    scores = _batch_scores(lake).withColumn("score", F.round("score", 6))
    pred = an.with_predictions(lake.rolling_table, scores, "user_id")
    path = shared_dir(spark, "batch_predictions")
    pred.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).drop("prediction_timestamp")


# --------------------------------------------------------------------------- prose features


@query("reciprocal_heavy_writers", with_ctes(
    "SELECT p.a_id AS id, p.n_pairs, w.n_writes FROM "
    "(SELECT e.src AS a_id, COUNT(*) AS n_pairs FROM edges e JOIN edges e2 ON e.dst = e2.src AND e.src = e2.dst "
    " WHERE e.src LIKE 'user_%' GROUP BY e.src) p JOIN "
    "(SELECT src, COUNT(DISTINCT id) AS n_writes FROM edges WHERE relationship IN ('file_written', 'file_updated') "
    " GROUP BY src) w ON w.src = p.a_id WHERE w.n_writes >= 10", "edges"))
def q_reciprocal_heavy_writers(spark, sf_dir):
    """Users in a reciprocal share motif who also write files often (>= 10 writes)."""
    edges = Lake(spark, sf_dir).edges
    pairs = (gr.reciprocal_pair_counts(edges).filter(F.col("a_id").startswith("user_"))
             .groupBy("a_id").agg(F.sum("n_pairs").alias("n_pairs")))
    writes = (edges.filter(F.col("relationship").isin("file_written", "file_updated"))
              .select("src", "id").distinct().groupBy("src").agg(F.count(F.lit(1)).alias("n_writes")))
    return (pairs.join(writes, pairs["a_id"] == writes["src"]).filter(F.col("n_writes") >= 10)
            .select(F.col("a_id").alias("id"), "n_pairs", "n_writes"))


@query("incremental_feature_refresh", with_ctes(
    "SELECT entity_id, min_ts, max_ts, LogDurationInDays, TotalFailedAttempts, TotalLoginAttempts FROM ("
    "SELECT entity_id, MIN(event_ts) AS min_ts, MAX(event_ts) AS max_ts, "
    "CAST(date_diff('day', MIN(event_ts), MAX(event_ts)) + 1 AS INTEGER) AS LogDurationInDays, "
    "COUNT(CASE WHEN event_type = 'login_failed' THEN id END) AS TotalFailedAttempts, "
    "COUNT(CASE WHEN event_type = 'login_attempt' THEN id END) AS TotalLoginAttempts FROM bronze "
    f"WHERE entity_type = 'name' AND event_type IN {LOGINS} GROUP BY entity_id) s", "bronze"))
def q_incremental_feature_refresh(spark, sf_dir):
    """Day partials of the history and of the new batch; only the users that the batch touched are
    summed anew, from their own partials, and upserted; equals a full recompute."""
    lake = Lake(spark, sf_dir)
    root, start = shared_dir(spark, "partials"), F.to_timestamp(F.lit(lake.batch_start))
    write = part.PartialsBatchWriter(root)
    write(lake.bronze_table.filter(F.col("event_ts") < start), 0)
    before = part.merged_logins(part.stored(spark, root, "logins"))
    write(lake.bronze_table.filter(F.col("event_ts") >= start), 1)
    cols = ["entity_id", "min_ts", "max_ts", "LogDurationInDays", "TotalFailedAttempts", "TotalLoginAttempts"]
    return upsert(before.select(*cols), part.touched_logins(spark, root, [1]).select(*cols), ["entity_id"])


def _stream_partials(lake: Lake) -> str:
    """Login and file partials of the bronze table, written by micro-batches; once per stored bronze table."""
    root = f"{lake.folder}/partials"
    lake.bronze_table                                   # noqa: B018 - stores it
    part.run_partials(lake.spark, f"{lake.folder}/bronze", root, f"{lake.folder}/ckpt_partials", max_files_per_trigger=2)
    return root


@query("login_features_from_partials", with_ctes("SELECT * FROM hist_login", "hist_login"))
def q_login_features_from_partials(spark, sf_dir):
    """P4 + F8: historical login features as sums of day partials; the cutoff's own day is read from bronze."""
    lake = Lake(spark, sf_dir)
    partials = part.stored(spark, _stream_partials(lake), "logins")
    return part.merged_logins(part.in_range(partials, lake.bronze_table, part.login_partials, None, datetime.fromisoformat(lake.cutoff)))


@query("file_features_from_partials", with_ctes("SELECT * FROM hist_files", "hist_files"))
def q_file_features_from_partials(spark, sf_dir):
    """P4 + F10: historical file features from day partials, distinct ids exact."""
    lake = Lake(spark, sf_dir)
    partials = part.stored(spark, _stream_partials(lake), "files")
    rows = part.in_range(partials, lake.edges, part.file_partials, None, datetime.fromisoformat(lake.cutoff))
    return part.merged_files(rows, lake.system_folders)


@query("rolling_login_from_partials", with_ctes("SELECT * FROM roll_login", "roll_login"))
def q_rolling_login_from_partials(spark, sf_dir):
    """P4 + F13: the batch users' rolling login features from day partials and two part days."""
    lake = Lake(spark, sf_dir)
    partials = part.stored(spark, _stream_partials(lake), "logins")
    bounds = lake.window.bounds.first()
    rows = part.in_range(partials, lake.bronze_table, part.login_partials, bounds["window_start"], bounds["max_ts"])
    users = lake.window.users.withColumnRenamed("entity_id", "user_join_key")
    return part.merged_logins(rows, bounds["max_ts"]).join(users, "user_join_key", "left_semi")


@query("ensemble_score", with_ctes(
    "SELECT k.id, ROUND((k.r + e.r) / 2.0, 6) AS ensemble_score FROM "
    "(SELECT id, (SUM(1) OVER (ORDER BY knn RANGE UNBOUNDED PRECEDING) - (COUNT(*) OVER (PARTITION BY knn) - 1) / 2.0) "
    " / COUNT(*) OVER () AS r FROM kn) k JOIN "
    "(SELECT id, (SUM(1) OVER (ORDER BY ecod RANGE UNBOUNDED PRECEDING) - (COUNT(*) OVER (PARTITION BY ecod) - 1) / 2.0) "
    " / COUNT(*) OVER () AS r FROM ec) e ON k.id = e.id", "training_frame", extra=[
        SPLIT_CTE, TRAIN_CTE, ("pairs", _knn_sql("train", "train", "id", True)),
        ("kn", f"SELECT qid AS id, ROUND(d, 6) AS knn FROM (SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) "
               f"rn FROM pairs) t WHERE rn = {K}"),
        *_ECOD_EXTRA,
        ("ec0", "SELECT id, ROUND(GREATEST(SUM(u_l), SUM(u_r), SUM(u_s)), 6) AS ecod FROM long "
                "JOIN tails USING (feature, value) GROUP BY id"),
        ("ec", "SELECT ec0.* FROM ec0 JOIN train ON ec0.id = train.id"),
    ]))
def q_ensemble_score(spark, sf_dir):
    """P5: mean of the normalised average ranks of the kNN and ECOD scores (training rows)."""
    lake = Lake(spark, sf_dir)
    tr = _train(lake)
    kn = knn_scores(tr, "id", FEATS, k=K).select("id", F.round("score", 6).alias("s"))
    ec = (an.ecod_scores(lake.training_table, "id", FEATS).join(tr.select("id"), "id", "left_semi")
          .select("id", F.round("score", 6).alias("s")))
    return an.ensemble_ranks({"knn": kn, "ecod": ec}, "id").select(
        "id", F.round("ensemble_score", 6).alias("ensemble_score"))


# --------------------------------------------------------------------------- streaming inference


def _stream_predictions(spark, sf_dir):
    from tracewise.plans.registry_io import MICRO_BATCH, _stream_bronze
    from tracewise.streaming import medallion as med
    lake = Lake(spark, sf_dir)
    ref, folders, edges = (shared_dir(spark, n) for n in ("training_reference", "system_folders", "edges"))
    _train(lake).write.mode("overwrite").parquet(ref)
    lake.edges.write.mode("overwrite").partitionBy("relationship").parquet(edges)
    lake.system_folders.write.mode("overwrite").parquet(folders)

    def scorer(frame):
        reference = frame.sparkSession.read.parquet(ref)
        scores = an.score(frame, "user_id", FEATS, reference, "id", detector="knn", params={"k": K})
        return scores.withColumn("score", F.round("score", 6))

    out, ckpt = shared_dir(spark, "predictions"), shared_dir(spark, "ckpt_inference")
    med.run_stream_inference(spark, _stream_bronze(spark, sf_dir), edges, folders, scorer, out, ckpt,
                             lookback_days=lake.lookback_days, max_bytes_per_trigger=MICRO_BATCH)
    return out


_FEED_SQL = (
    "SELECT {0}f.*, ROUND(s.d, 6) AS predictions FROM feed_frame f LEFT JOIN "
    "(SELECT qid, d FROM (SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) rn FROM pairs) t "
    f"WHERE rn = {K}) s ON s.qid = f.user_id")
_FEED_CTES = [SPLIT_CTE, TRAIN_CTE, ("pairs", _knn_sql("feed_frame", "train", "user_id", False))]


@query("stream_inference", with_ctes(_FEED_SQL.format(""), "training_frame", "feed_frame", extra=_FEED_CTES))
def q_stream_inference(spark, sf_dir):
    """Rolling features + kNN scores per micro-batch; the latest prediction per user."""
    from tracewise.streaming import medallion as med
    return med.latest_predictions(spark, _stream_predictions(spark, sf_dir)).drop("prediction_timestamp")


@query("prediction_history", with_ctes(_FEED_SQL.format("0 AS batch_id, "), "training_frame", "feed_frame", extra=_FEED_CTES))
def q_prediction_history(spark, sf_dir):
    """Predictions kept per batch id instead of overwritten."""
    return spark.read.parquet(_stream_predictions(spark, sf_dir)).drop("prediction_timestamp")


# --------------------------------------------------------------------------- model runs (labelled documents)

_DOC_COLS = ["n_chars", "n_words", "n_lines", "digit_frac", "upper_frac"]
_T = "COALESCE(text, '')"
_DOC_CTES = [
    ("docs", f"""SELECT doc_id,
      CAST(length({_T}) AS DOUBLE) AS n_chars,
      CAST(len(regexp_split_to_array(trim({_T}), '\\s+')) AS DOUBLE) AS n_words,
      CAST(len(string_split({_T}, chr(10))) AS DOUBLE) AS n_lines,
      length(regexp_replace({_T}, '[^0-9]', '', 'g')) / greatest(length({_T}), 1) AS digit_frac,
      length(regexp_replace({_T}, '[^A-Z]', '', 'g')) / greatest(length({_T}), 1) AS upper_frac
    FROM documents"""),
    ("dtrain", "SELECT * FROM docs WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 >= 1"),
    ("lab", "SELECT d.*, l.toxic FROM docs d JOIN labels l ON d.doc_id = l.doc_id"),
    ("dpairs", "SELECT a.doc_id AS qid, sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _DOC_COLS)
     + ") AS d FROM lab a JOIN dtrain b ON a.doc_id <> b.doc_id"),
    ("drk", "SELECT qid, d, row_number() OVER (PARTITION BY qid ORDER BY d) AS rn FROM dpairs"),
    ("dknn", "SELECT qid, " + ", ".join(f"ROUND(MAX(CASE WHEN rn = {k} THEN d END), 9) AS k{k}" for k in an.KNN_KS)
     + " FROM drk WHERE rn <= 10 GROUP BY qid"),
    ("dref", "SELECT " + ", ".join(_DOC_COLS) + " FROM dtrain UNION ALL SELECT " + ", ".join(_DOC_COLS) + " FROM lab"),
    ("dref_long", "SELECT feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT dref ON " + ", ".join(_DOC_COLS)
     + " INTO NAME feature VALUE value)"),
    ("dpts_long", "SELECT doc_id, feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT doc_id, "
     + ", ".join(_DOC_COLS) + " FROM lab) ON " + ", ".join(_DOC_COLS) + " INTO NAME feature VALUE value)"),
    ("dcnt", "SELECT feature, value, COUNT(*) AS c FROM dref_long GROUP BY feature, value"),
    ("dcum", "SELECT feature, value, c, SUM(c) OVER (PARTITION BY feature ORDER BY value) AS cum_le FROM dcnt"),
    ("dstat", "SELECT feature, COUNT(*) AS n, skewness(value) AS skew FROM dref_long GROUP BY feature"),
    ("dtails", "SELECT dcum.feature, value, -ln(cum_le / n) AS u_l, -ln((n - cum_le + c) / n) AS u_r, "
     "CASE WHEN skew < 0 THEN -ln(cum_le / n) ELSE -ln((n - cum_le + c) / n) END AS u_s "
     "FROM dcum JOIN dstat ON dcum.feature = dstat.feature"),
    ("decod", "SELECT doc_id AS qid, ROUND(GREATEST(SUM(u_l), SUM(u_r), SUM(u_s)), 9) AS e FROM dpts_long "
     "JOIN dtails USING (feature, value) GROUP BY doc_id"),
    ("dscores", "SELECT lab.doc_id, lab.toxic AS y, k.k3, k.k5, k.k10, e.e FROM lab "
     "LEFT JOIN dknn k ON k.qid = lab.doc_id LEFT JOIN decod e ON e.qid = lab.doc_id"),
]


def _auc_sql(model_id: str, detector: str, params: str, col: str) -> str:
    g = f"(SELECT {col} AS s, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, COUNT(*) AS c FROM dscores " \
        f"WHERE {col} IS NOT NULL AND y IS NOT NULL GROUP BY {col})"
    r = f"(SELECT *, SUM(c) OVER (ORDER BY s) - c + (c + 1) / 2.0 AS avg_rank FROM {g})"
    auc = "(SUM(pos * avg_rank) - SUM(pos) * (SUM(pos) + 1) / 2.0) / (SUM(pos) * (SUM(c) - SUM(pos)))"
    return (f"SELECT '{model_id}' AS model_id, '{detector}' AS detector, '{params}' AS params, "
            f"ROUND(-{auc}, 6) AS loss, CASE WHEN {auc} IS NOT NULL THEN 'FINISHED' ELSE 'FAILED' END AS status FROM {r}")


_RUNS_SQL = " UNION ALL ".join(
    [_auc_sql(f"knn_k{k}", "knn", f'{{"k": {k}}}', f"k{k}") for k in an.KNN_KS] + [_auc_sql("ecod", "ecod", "{}", "e")])
_RUN_CTES = _DOC_CTES + [("runs", _RUNS_SQL),
                         ("best", "SELECT * FROM runs WHERE status = 'FINISHED' ORDER BY loss, model_id LIMIT 1")]


def _runs(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    feats = an.document_features(lake.table("documents"))
    runs = an.model_runs(feats, lake.table("labels"), "doc_id", an.DOC_FEATURES, "toxic")
    return runs.withColumn("loss", F.round("loss", 6))


@query("model_runs", with_ctes("SELECT * FROM runs", extra=_RUN_CTES))
def q_model_runs(spark, sf_dir):
    """M4 + M5: candidate detectors fitted on the training split of the document profiles,
    scored on labelled documents; loss = -ROC-AUC against the toxic label."""
    return _runs(spark, sf_dir)


@query("best_model", with_ctes("SELECT * FROM best", extra=_RUN_CTES))
def q_best_model(spark, sf_dir):
    """Lowest-loss finished run."""
    return an.select_best(_runs(spark, sf_dir))


@query("latest_production_model", with_ctes(
    "SELECT 'user_anomaly_detector' AS name, CAST(v.version AS INTEGER) AS version, v.model_id FROM "
    "(SELECT model_id, row_number() OVER (ORDER BY model_id) AS version FROM runs) v JOIN best b "
    "ON v.model_id = b.model_id", extra=_RUN_CTES))
def q_latest_production_model(spark, sf_dir):
    """M8: register every run as a version, promote the best, fetch the latest production version from the log."""
    registry = ModelRegistry(spark, shared_dir(spark, "registry"), "user_anomaly_detector")
    runs = sorted(_runs(spark, sf_dir).collect(), key=lambda r: r["model_id"])       # a row per candidate
    for r in runs:
        registry.register(r["model_id"], r["detector"], r["params"], loss=r["loss"])
    done = [(r["loss"], r["model_id"], n) for n, r in enumerate(runs, 1) if r["status"] == "FINISHED"]
    if done:
        registry.promote(min(done)[2])
    return registry.versions().where("stage = 'Production'").select("name", "version", "model_id")


@query("model_registry_history", with_ctes(
    "SELECT 'user_anomaly_detector' AS name, CAST(version AS INTEGER) AS version, model_id, ROUND(loss, 6) AS loss, "
    "CASE WHEN promoted AND version = MAX(CASE WHEN promoted THEN version END) OVER () THEN 'Production' "
    "WHEN promoted THEN 'Archived' ELSE 'None' END AS stage, CAST(promoted AS BIGINT) AS transitions FROM ("
    "SELECT *, status = 'FINISHED' AND loss < COALESCE(MIN(CASE WHEN status = 'FINISHED' THEN loss END) OVER "
    "(ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e300) AS promoted FROM ("
    "SELECT *, row_number() OVER (ORDER BY model_id) AS version FROM runs) r) p", extra=_RUN_CTES))
def q_model_registry_history(spark, sf_dir):
    """M8: the log after runs came in one by one, each promoted if it beat the version then in Production."""
    registry = ModelRegistry(spark, shared_dir(spark, "registry"), "user_anomaly_detector")
    for r in sorted(_runs(spark, sf_dir).collect(), key=lambda r: r["model_id"]):
        version, now = registry.register(r["model_id"], r["detector"], r["params"], loss=r["loss"]), registry.latest()
        if r["status"] == "FINISHED" and (now is None or r["loss"] < now["loss"]):
            registry.promote(version)
    return registry.versions().select("name", "version", "model_id", F.round("loss", 6).alias("loss"), "stage", "transitions")


@query("inne_score")
def q_inne_score(spark, sf_dir):
    """M4 INNE over the training rows (100 samples of 16 centres)."""
    from tracewise.operators.ensembles import inne_scores
    tr = _train(Lake(spark, sf_dir)).checkpoint()
    return inne_scores(tr, "id", FEATS)


@query("iforest_score")
def q_iforest_score(spark, sf_dir):
    """M4 isolation forest over the training rows (100 trees on 256-row samples)."""
    from tracewise.operators.ensembles import iforest_scores
    tr = _train(Lake(spark, sf_dir)).checkpoint()
    return iforest_scores(tr, "id", FEATS)


_BOX = ", ".join(f"min({c})::DOUBLE AS lo_{c}, max({c})::DOUBLE AS hi_{c}" for c in FEATS)
_DRAWS = ", ".join(f"lo_{c} + (('0x' || substr(md5('11:{j}:' || i), 1, 13))::BIGINT::DOUBLE / {16 ** 13}::DOUBLE) * (hi_{c} - lo_{c}) AS {c}"
                   for j, c in enumerate(FEATS))
_VOLUME = " * ".join(f"CASE WHEN hi_{c} > lo_{c} THEN hi_{c} - lo_{c} ELSE 1 END" for c in FEATS)


def _knn_normality(points: str, pid: str, exclude_self: bool) -> str:
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS)
    other = "a.id <> b.id" if exclude_self else "TRUE"
    return (f"SELECT round(-sqrt(list_sort(list({dist}))[{K}]), 9) AS s FROM {points} a JOIN train b ON {other} "
            f"GROUP BY a.{pid} HAVING count(*) >= {K}")


@query("excess_mass", with_ctes(
    "SELECT 'knn_k5' AS model_id, round(sum((em + em_next) / 2 * 0.01), 6) AS em_times_volume, "
    "round((SELECT log10(volume) FROM vol), 6) AS log_volume, any_value(k_max)::BIGINT AS k_max FROM area WHERE k + 1 < k_max",
    "training_frame", extra=[
        SPLIT_CTE, TRAIN_CTE,
        ("rated", "SELECT * FROM split WHERE split = CASE WHEN (SELECT count(*) FROM split WHERE split = 'test') > 0 THEN 'test' ELSE 'train' END"),
        ("box", f"SELECT {_BOX} FROM rated"),
        ("uniform", f"SELECT i AS uid, {_DRAWS} FROM range(100000) r(i), box"),
        ("vol", f"SELECT {_VOLUME} AS volume FROM box"),
        ("sx", _knn_normality("rated", "id", True)), ("su", _knn_normality("uniform", "uid", False)),
        ("nums", "SELECT (SELECT count(*) FROM sx) AS nx, (SELECT count(*) FROM su) AS nu"),
        ("lines", "SELECT v, (SELECT count(*) FROM sx WHERE s > v) / nx AS a, (SELECT count(*) FROM su WHERE s > v) / nu AS b "
                  "FROM (SELECT DISTINCT s AS v FROM sx) d, nums"),
        ("curve", "SELECT k, CASE WHEN k = 0 THEN 1.0::DOUBLE ELSE max(a - b * (k * 0.01::DOUBLE)) END AS em FROM range(10000) g(k), lines GROUP BY k"),
        ("stop", "SELECT CASE WHEN coalesce(min(k), 0) = 0 THEN 9999 ELSE min(k) + 1 END AS k_max FROM curve WHERE em <= 0.9"),
        ("area", "SELECT k, em, lead(em) OVER (ORDER BY k) AS em_next, k_max FROM curve, stop")]))
def q_excess_mass(spark, sf_dir):
    """M5 (no labels): excess-mass area of the kNN detector, fitted on the training split, on the test
    split versus uniform rows (md5 draws) in its bounding box; the area is given free of the box's volume."""
    lake = Lake(spark, sf_dir)
    trial = an.ExcessMassTrial(lake.training_table, "id", FEATS, shared_dir(spark, "models"))
    model = trial.fit("knn_k5", "knn", {"k": K})
    scores = [model.score(trial.test, "id", exclude_self=True), model.score(trial.uniform, "uid")]
    em = trial.rate(*[s.where("score is not null").select(F.round("score", 9).alias("score")) for s in scores])
    return em.select(F.lit("knn_k5").alias("model_id"), F.round(F.col("em") * F.col("volume"), 6).alias("em_times_volume"),
                     F.round(F.log10("volume"), 6).alias("log_volume"), F.col("k_max").cast("long").alias("k_max"))


@query("score_with_model_udf")
def q_score_with_model_udf(spark, sf_dir):
    """K3 + D14 + M6: the active batch scored by a fitted model applied as a vectorised
    UDF on the packed feature struct, with the prediction time (isolation forest)."""
    from tracewise.operators.ensembles import fit_iforest, model_udf
    lake = Lake(spark, sf_dir)
    model = fit_iforest(_train(lake).checkpoint(), "id", FEATS)
    predict = model_udf(spark, model, FEATS)
    return (lake.rolling_frame
            .withColumn("predictions", predict(F.struct(*[F.col(c) for c in FEATS])))
            .withColumn("prediction_timestamp", F.current_timestamp()))


def _search_store(lake: Lake) -> str:
    return f"{lake.folder}/models/search"


def _runs_unlabelled(lake: Lake):
    """The search over the stored training frame: run once, its runs and fitted models are kept as tables."""
    path = f"{_search_store(lake)}/runs"
    if not path_exists(lake.spark, f"{path}/_SUCCESS"):
        an.model_runs_unlabelled(lake.training_table, "id", FEATS, store=_search_store(lake)).coalesce(1).write.mode("overwrite").parquet(path)
    return lake.spark.read.parquet(path)


@query("model_runs_unlabelled")
def q_model_runs_unlabelled(spark, sf_dir):
    """M4 + M5 as configured in the source (no ground truth): the user detectors
    ranked by excess mass; loss = -em."""
    return _runs_unlabelled(Lake(spark, sf_dir)).drop("artefact")


@query("best_model_unlabelled")
def q_best_model_unlabelled(spark, sf_dir):
    """M7 over the unlabelled runs."""
    return an.select_best(_runs_unlabelled(Lake(spark, sf_dir))).drop("artefact")


def production_model(lake: Lake) -> tuple[dict, models.Model]:
    """The version in Production and its fitted model; the search runs and registers where there is none yet."""
    registry = ModelRegistry(lake.spark, f"{lake.folder}/models/registry", "user_anomaly_detector")
    now = registry.latest()
    if now is None:
        best = an.select_best(_runs_unlabelled(lake)).first()
        if best is None:
            raise ValueError("no candidate has finished")
        registry.promote(registry.register(best["model_id"], best["detector"], best["params"], best["artefact"], best["loss"]))
        now = registry.latest()
    return now, models.load(lake.spark, now["artefact"])


@query("score_with_production_model")
def q_score_with_production_model(spark, sf_dir):
    """M6 + M8: the stored, fitted production model is loaded and scores the active batch; no training row is read."""
    lake = Lake(spark, sf_dir)
    version, model = production_model(lake)
    return model.score(lake.rolling_table, "user_id").select(
        "user_id", F.lit(version["version"]).alias("version"), F.lit(version["model_id"]).alias("model_id"), F.round("score", 6).alias("score"))


SEARCH_EVALUATIONS, SEARCH_PARALLEL = 8, 4


@query("model_search")
def q_model_search(spark, sf_dir):
    """M4: candidates drawn by a Parzen sampler, fitted, stored and rated by excess mass, four at a time."""
    lake = Lake(spark, sf_dir)
    path = f"{lake.folder}/models/parzen"
    if not path_exists(spark, f"{path}/runs/_SUCCESS"):
        trial = an.ExcessMassTrial(lake.training_table, "id", FEATS, path)
        found = srch.search(lambda *c: trial.run(*c).first().asDict(), srch.DETECTORS, SEARCH_EVALUATIONS, SEARCH_PARALLEL,
                            startup=SEARCH_PARALLEL, spark=spark)
        srch.history_table(spark, found).coalesce(1).write.mode("overwrite").parquet(f"{path}/runs")
    return spark.read.parquet(f"{path}/runs").drop("artefact")


@query("ensemble_of_best_models")
def q_ensemble_of_best_models(spark, sf_dir):
    """P5: the active batch ranked by the stored best model of every detector of the search, ranks averaged."""
    lake = Lake(spark, sf_dir)
    best = an.best_per_detector(_runs_unlabelled(lake)).collect()            # a row per detector
    scores = {b["detector"]: models.load(spark, b["artefact"]).score(lake.rolling_table, "user_id")
              .select(F.col("user_id"), F.round("score", 9).alias("s")) for b in sorted(best, key=lambda b: b["detector"])}
    return an.ensemble_ranks(scores, "user_id").select("user_id", F.round("ensemble_score", 6).alias("ensemble_score"))
