"""Property checks against brute force on small inputs derived from the test tables."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import FEATURES
from tracewise.operators import anomaly as an
from tracewise.operators.graph import connected_components, degrees
from tracewise.operators.knn import knn_scores
from tracewise.operators.upsert import EDGE_KEYS, upsert
from tracewise.plans.lake import Lake

SF = "/root/testdata/sf0.001"


def test_upsert_twice_equals_once(spark):
    lake = Lake(spark, SF, materialize=False)
    e = lake.edges
    half = e.filter(F.col("id") % 2 == 0)
    once = upsert(half, e, EDGE_KEYS)
    twice = upsert(once, e, EDGE_KEYS)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == e.count()


def test_degree_sum_is_twice_edges(spark):
    e = Lake(spark, SF, materialize=False).edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    total = degrees(e).agg(F.sum("degree")).first()[0]
    assert total == 2 * e.count()


def _union_find(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for i in ids:
        groups.setdefault(find(i), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_components_label_is_min_id(spark):
    lake = Lake(spark, SF, materialize=False)
    v = lake.vertices.select("id")
    cc = {r["id"]: r["component"] for r in connected_components(v, lake.edges).collect()}
    ids = [r[0] for r in v.collect()]
    pairs = [(r["src"], r["dst"]) for r in lake.edges.select("src", "dst").collect()
             if r["src"] in cc and r["dst"] in cc and r["src"] != r["dst"]]
    assert cc == _union_find(ids, pairs)


def test_components_chain_and_star(spark):
    verts = spark.createDataFrame([(f"v{i:02d}",) for i in range(20)], "id string")
    chain = [(f"v{i:02d}", f"v{i + 1:02d}") for i in range(9)]
    star = [("v15", f"v{j:02d}") for j in (10, 11, 12, 13, 14, 16)]
    e = spark.createDataFrame(chain + star, "src string, dst string")
    got = {r["id"]: r["component"] for r in connected_components(verts, e).collect()}
    assert all(got[f"v{i:02d}"] == "v00" for i in range(10))
    assert all(got[f"v{j:02d}"] == "v10" for j in range(10, 17))
    assert got["v19"] == "v19"


def _brute_knn(x, k, exclude_self=True):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    if exclude_self:
        np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, k - 1]


def test_knn_exact_on_embeddings(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    cols = [f"f{i}" for i in range(16)]
    frame = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    rows = sorted(frame.collect(), key=lambda r: r["vec_id"])
    x = np.array([[r[c] for c in cols] for r in rows])
    want = dict(zip([r["vec_id"] for r in rows], _brute_knn(x, 5)))
    got = {r["vec_id"]: r["score"] for r in knn_scores(frame, "vec_id", cols, k=5, cell_rows=64).collect()}
    assert set(got) == set(want)
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9, abs_tol=1e-9) for i in want)


def test_knn_with_heavy_duplicates(spark):
    data = [(i, 0.0, 0.0) for i in range(300)] + [(300 + i, float(i), float(i % 7)) for i in range(100)]
    frame = spark.createDataFrame(data, "id long, a double, b double")
    x = np.array([[a, b] for _, a, b in data])
    want = _brute_knn(x, 5)
    got = {r["id"]: r["score"] for r in knn_scores(frame, "id", ["a", "b"], k=5, cell_rows=32).collect()}
    assert all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in range(len(data)))


def test_ecod_matches_numpy(spark):
    tf = Lake(spark, SF, materialize=False).training_frame
    rows = sorted(tf.collect(), key=lambda r: r["id"])
    x = np.array([[r[c] for c in FEATURES] for r in rows], dtype=float)
    n = len(x)
    left = np.array([[(x[:, j] <= x[i, j]).sum() / n for j in range(x.shape[1])] for i in range(n)])
    right = np.array([[(x[:, j] >= x[i, j]).sum() / n for j in range(x.shape[1])] for i in range(n)])
    mean = x.mean(0)
    skew = ((x - mean) ** 3).mean(0)
    ul, ur = -np.log(left), -np.log(right)
    us = np.where(skew < 0, ul, ur)
    want = np.maximum(np.maximum(ul.sum(1), ur.sum(1)), us.sum(1))
    got = {r["id"]: r["score"] for r in an.ecod_scores(tf, "id", list(FEATURES)).collect()}
    for r, w in zip(rows, want):
        assert math.isclose(got[r["id"]], w, rel_tol=1e-9, abs_tol=1e-9)


def test_roc_auc_matches_pairs(spark):
    data = [(float(s), int(y)) for s, y in [(1, 0), (2, 0), (2, 1), (3, 1), (3, 0), (5, 1), (0, 0), (4, 1)]]
    df = spark.createDataFrame(data, "s double, y int")
    pos = [s for s, y in data if y == 1]
    neg = [s for s, y in data if y == 0]
    want = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg) / (len(pos) * len(neg))
    got = an.roc_auc(df, "s", "y").first()["auc"]
    assert math.isclose(got, want)


def test_cumulative_by_value_many_blocks(spark):
    df = spark.createDataFrame([(g, float(v), 1) for g in ("a", "b") for v in range(200)],
                               "g string, v double, c int")
    got = {(r["g"], r["v"]): r["cum_le"] for r in an.cumulative_by_value(df, "g", "v", "c", blocks=16).collect()}
    assert all(got[(g, float(v))] == v + 1 for g in ("a", "b") for v in range(200))


def test_hash_split_is_stable(spark):
    tf = Lake(spark, "/root/testdata/sf0.01", materialize=False).training_frame
    a = {r["id"]: r["split"] for r in an.train_test_split(tf).collect()}
    b = {r["id"]: r["split"] for r in an.train_test_split(tf).collect()}
    assert a == b and 0 < sum(v == "test" for v in a.values()) < len(a)


def test_ensemble_detectors_rank_an_outlier_first(spark):
    from tracewise.operators.ensembles import iforest_scores, inne_scores
    rng = np.random.default_rng(3)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, size=(300, 2)))]
    pts.append((999, 25.0, -25.0))
    frame = spark.createDataFrame(pts, "id long, a double, b double")
    for fn in (inne_scores, iforest_scores):
        got = {r["id"]: r["score"] for r in fn(frame, "id", ["a", "b"], samples=20, psi=16).collect()} \
            if fn is inne_scores else \
            {r["id"]: r["score"] for r in fn(frame, "id", ["a", "b"], trees=30, psi=64).collect()}
        assert len(got) == len(pts)
        assert all(0.0 <= v <= 1.0 for v in got.values())
        assert max(got, key=got.get) == 999


def test_excess_mass_matches_numpy(spark):
    rng = np.random.default_rng(5)
    sx = np.round(rng.normal(0, 1, 300), 3)
    su = np.round(rng.uniform(-4, 4, 2000), 3)
    vol = 8.0
    t = np.arange(10000) * 0.01 / vol
    em = np.zeros(10000)
    em[0] = 1.0
    for u in np.unique(sx):
        em = np.maximum(em, (sx > u).mean() - t * (su > u).mean() * vol)
    amax = int(np.argmax(em <= 0.9)) + 1
    if amax == 1:
        amax = -1
    want = float(((em[:amax][1:] + em[:amax][:-1]) / 2 * np.diff(t[:amax])).sum())
    got = an.excess_mass(spark.createDataFrame([(float(v),) for v in sx], "s double"),
                         spark.createDataFrame([(float(v),) for v in su], "s double"),
                         spark.createDataFrame([(vol,)], "volume double")).first()
    assert math.isclose(got["em"], want, rel_tol=1e-9)
    assert got["k_max"] == amax


def test_model_udf_equals_batch_scoring(spark):
    from tracewise.operators.ensembles import fit_iforest, iforest_scores, model_udf
    rng = np.random.default_rng(4)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, size=(200, 2)))]
    frame = spark.createDataFrame(pts, "id long, a double, b double")
    model = fit_iforest(frame, "id", ["a", "b"], trees=20, psi=64)
    via_udf = {r["id"]: r["p"] for r in frame.select(
        "id", model_udf(spark, model, ["a", "b"])(F.struct("a", "b")).alias("p")).collect()}
    batch = {r["id"]: r["score"] for r in iforest_scores(frame, "id", ["a", "b"], trees=20, psi=64).collect()}
    assert all(math.isclose(via_udf[i], batch[i]) for i in batch)


def test_components_of_a_long_chain(spark):
    from tracewise.operators.graph import connected_components
    n = 300
    r = np.random.default_rng(3)
    ids = r.permutation(n).tolist()
    edges = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1)], "src long, dst long")
    got = connected_components(spark.range(n + 1), edges).collect()
    assert {row["component"] for row in got if row["id"] < n} == {0} and len(got) == n + 1


def test_answers_are_counted_without_pairs(spark):
    """A hot (share, token) pair: the owner meets one number; ids with several pairs still count once."""
    from tracewise.operators import features as feat
    rows = [(1, "shared_link", "user_a", "share_obj_1", "user_t"), (2, "shared_link", "user_b", "share_obj_1", "user_t"),
            (3, "shared_link", "user_a", "share_obj_2", "user_t")]
    rows += [(100 + i, "public_share_accessed", "share_obj_1", "user_t", None) for i in range(500)]
    rows += [(900, "public_share_accessed", "share_obj_1", "user_t", None), (900, "public_share_accessed", "share_obj_2", "user_t", None),
             (901, "public_share_accessed", "share_obj_9", "user_t", None), (None, "public_share_accessed", "share_obj_1", "user_t", None)]
    e = spark.createDataFrame(rows, "id long, relationship string, src string, dst string, entity_sub_relationship string")
    shares = e.where("relationship = 'shared_link'")
    got = {r["src"]: r[1] for r in feat.reciprocal_access_counts(shares, e).collect()}
    assert got == {"user_a": 501, "user_b": 501}
    pairs = feat.reciprocal_access_ids(shares, e).groupBy("src").count().collect()
    assert {r["src"]: r["count"] for r in pairs} == got


def test_answers_are_not_shuffled(spark, tmp_path):
    """100 owners of one place and 100 accesses make 10,000 rows; both sides are shuffled, the rows are not."""
    from tracewise.operators import features as feat
    rows = [(i, "shared_link", f"user_{i}", "share_obj_1", "user_t") for i in range(100)]
    rows += [(1000 + i, "public_share_accessed", "share_obj_1", "user_t", None) for i in range(100)]
    e = spark.createDataFrame(rows, "id long, relationship string, src string, dst string, entity_sub_relationship string")
    found = feat.reciprocal_access_ids(e.where("relationship = 'shared_link'"), e)
    assert found.count() == found.distinct().count() == 10_000
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"                          # no aggregate above the join of single places
    first = plan.children().apply(0)
    assert [first.nodeName(), first.children().apply(0).nodeName()] == ["Project", "Join"]


def test_knn_with_many_groups_of_cells(spark):
    from tracewise.operators.knn import knn_scores
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(400, 3)), 3)
    df = spark.createDataFrame([(f"p{i}", *map(float, v)) for i, v in enumerate(x)], "id string, a double, b double, c double")
    got = {row["id"]: row["score"] for row in knn_scores(df, "id", ["a", "b", "c"], k=4, cell_rows=16, most_groups=5).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = np.sort(d + np.diag(np.full(400, np.inf)), axis=1)[:, 3]
    assert all(abs(got[f"p{i}"] - want[i]) < 1e-9 for i in range(400))


def _wide_and_narrow(n: int):
    """One wide feature, as lengths of texts are, and three narrow ones."""
    r = np.random.default_rng(9)
    return np.column_stack([r.permutation(n).astype(float), r.uniform(size=(n, 3))])


def test_cells_follow_the_widest_feature(spark):
    """Cells are cut where rows lie apart, so few are near a query; quantile ranks cut all features alike."""
    from tracewise.operators.knn import build_cells
    x = _wide_and_narrow(4096)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double, d double")
    cells = build_cells(df, "id", ["a", "b", "c", "d"], cell_rows=128).groupBy("cell").agg(
        (F.max(F.col("v")[0]) - F.min(F.col("v")[0])).alias("width"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(c["n"] for c in cells) == 4096 and 24 <= len(cells) <= 32
    assert sum(c["width"] for c in cells) < 4096          # they do not overlap
    assert max(c["n"] for c in cells) < 4 * 128


def test_equal_rows_are_dealt_over_cells(spark):
    from tracewise.operators.knn import build_cells, knn_scores
    df = spark.range(1000).selectExpr("id", "1.0D as a", "2.0D as b")
    sizes = [c["count"] for c in build_cells(df, "id", ["a", "b"], cell_rows=100).groupBy("cell").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 300
    assert knn_scores(df, "id", ["a", "b"], k=3, cell_rows=100).where("score = 0").count() == 1000


def test_kernel_equals_all_pairs():
    """Ties, own rows, a bound per query, queries without a distance, large offsets."""
    from tracewise.operators.knn import _nearest
    r = np.random.default_rng(4)
    for v, q in ((r.integers(0, 6, (900, 5)).astype(float), r.integers(0, 6, (300, 5)).astype(float)),
                 (r.normal(size=(700, 3)) + 1e6, r.normal(size=(200, 3)) + 1e6), (_wide_and_narrow(1000), _wide_and_narrow(500)),
                 (np.ones((3, 2)), np.ones((4, 2))), (np.ones((1, 1)), np.array([[np.nan], [1.0], [2.0]]))):
        rid, qid = np.arange(len(v)), np.arange(len(q))
        d2 = np.zeros((len(q), len(v)))
        for c in range(v.shape[1]):
            d2 += (q[:, None, c] - v[None, :, c]) ** 2
        for bound in (np.full(len(q), np.inf), r.uniform(0, 3, len(q))):
            for exclude in (False, True):
                d = np.where((np.sqrt(d2) < bound[:, None]) & ~(exclude & (qid[:, None] == rid[None])), np.sqrt(d2), np.inf)
                want = np.sort(np.concatenate([d, np.full((len(q), 6), np.inf)], axis=1), axis=1)[:, :6]
                assert np.array_equal(_nearest(q, qid, bound, v, rid, 6, exclude), want)


def test_model_runs_and_ranks_search_once(spark, monkeypatch):
    """The detectors' scores are read by several jobs and computed by one."""
    from tracewise.operators import anomaly as an
    x = _wide_and_narrow(300)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double, d double")
    labels = df.selectExpr("id", "int(id % 2) as y")
    seen, auc = [], an.roc_auc

    def watched(scored, *columns):
        seen.append(scored._jdf.queryExecution().optimizedPlan().toString())
        return auc(scored, *columns)

    monkeypatch.setattr(an, "roc_auc", watched)
    an.model_runs(df, labels, "id", ["a", "b", "c", "d"], "y").collect()
    assert len(seen) == 4 and not [p for p in seen if "CoGroups" in p]
    lazy = df.select("id", "a").mapInPandas(lambda batches: (b.rename(columns={"a": "s"}) for b in batches), "id long, s double")
    assert "MapInPandas" not in an.normalised_ranks(lazy, "id")._jdf.queryExecution().optimizedPlan().toString()


def test_scoring_takes_every_detector(spark):
    from tracewise.operators import anomaly as an
    r = np.random.default_rng(6)
    rows = [(f"p{i}", *map(float, v)) for i, v in enumerate(r.normal(size=(120, 2)))]
    ref = spark.createDataFrame(rows, "id string, a double, b double")
    new = spark.createDataFrame([("in", 0.0, 0.0), ("out", 50.0, 50.0)], "user_id string, a double, b double")
    for detector, params in (("knn", {"k": 3}), ("ecod", {}), ("inne", {"psi": 8}), ("iforest", {"psi": 64, "trees": 20})):
        got = {row["user_id"]: row["score"] for row in an.score(new, "user_id", ["a", "b"], ref, "id", detector, params).collect()}
        assert got["out"] > got["in"], detector
    runs = spark.createDataFrame([("knn_k3", "knn", '{"k": 3}', -0.5, "FINISHED"), ("inne_psi8", "inne", '{"psi": 8}', -0.9, "FINISHED")],
                                 "model_id string, detector string, params string, loss double, status string")
    assert an.select_best(runs).first()["model_id"] == "inne_psi8"
