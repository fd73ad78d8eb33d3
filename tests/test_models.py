"""Fitted models as tables, the version log, and the envelope of the excess-mass curve."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import FEATURES
from tracewise.operators import anomaly as an
from tracewise.operators import models
from tracewise.operators.model_registry import ModelRegistry, VersionConflict
from tracewise.plans.lake import Lake
from tracewise.session import shared_dir

SF = "/root/testdata/sf0.001"
FEATS = list(FEATURES)
FITS = [("knn", {"k": 3}), ("ecod", {}), ("inne", {"psi": 4}), ("iforest", {"psi": 8, "trees": 20})]


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF)


@pytest.mark.parametrize("detector,params", FITS)
def test_loaded_model_equals_fit_and_score(spark, lake, detector, params):
    train, batch = lake.training_table, lake.rolling_table
    path = shared_dir(spark, "model")
    models.fit(train, "id", FEATS, detector, params, path)
    model = models.load(spark, path)
    got = {r["user_id"]: r["score"] for r in model.score(batch, "user_id").collect()}
    want = {r["user_id"]: r["score"] for r in an.score(batch, "user_id", FEATS, train, "id", detector, params).collect()}
    assert got.keys() == want.keys() and got
    assert all(got[u] == pytest.approx(want[u], abs=1e-9) for u in want)


@pytest.mark.parametrize("detector,params", FITS)
def test_scoring_reads_only_the_model_and_the_batch(spark, lake, detector, params):
    path = shared_dir(spark, "model")
    models.fit(lake.training_table, "id", FEATS, detector, params, path)
    points = lake.rolling_table
    read = models.load(spark, path)
    files = {f for t in read.tables.values() for f in t.inputFiles()}
    assert files and all(path.rsplit('/', 1)[1] in f for f in files)
    plan = read.score(points, "user_id")._jdf.queryExecution().toString()
    assert "training_frame" not in plan


def test_stored_frames_are_written_once(spark, lake):
    lake.bronze_table, lake.edges, lake.training_table          # noqa: B018
    again = Lake(spark, SF)
    before = sorted(again.bronze_table.inputFiles())
    assert before == sorted(lake.bronze_table.inputFiles()) and again.folder == lake.folder
    assert Lake(spark, SF, cutoff="2024-01-10 00:00:00").folder != lake.folder


def test_second_registration_archives_the_first(spark):
    registry = ModelRegistry(spark, shared_dir(spark, "registry"), "m")
    assert registry.latest() is None and registry.last() == (0, 0)
    registry.promote(registry.register("a", "knn", "{}"))
    registry.promote(registry.register("b", "ecod", "{}", loss=-1.0))
    other = ModelRegistry(spark, registry.folder.rsplit("/", 2)[0], "m")     # a later session reads the same log
    assert {(r["version"], r["model_id"], r["stage"], r["transitions"]) for r in other.versions().collect()} == {
        (1, "a", "Archived", 1), (2, "b", "Production", 1)}
    assert other.latest()["model_id"] == "b"
    other.promote(1)                                                          # back to the first
    assert registry.latest()["model_id"] == "a" and registry.latest("Archived")["model_id"] == "b"
    with pytest.raises(ValueError):
        registry.promote(9)


def test_the_slower_of_two_writers_fails_and_changes_nothing(spark):
    root = shared_dir(spark, "registry")
    one, two = ModelRegistry(spark, root, "m"), ModelRegistry(spark, root, "m")
    one.register("a", "knn", "{}")
    seen = one.last(), two.last()
    assert one.register("b", "knn", "{}", last=seen[0]) == 2
    with pytest.raises(VersionConflict):
        two.register("c", "knn", "{}", last=seen[1])
    assert [r["model_id"] for r in two.versions().orderBy("version").collect()] == ["a", "b"]
    assert two.register("c", "knn", "{}") == 3                                # read again, then commit
    with pytest.raises(VersionConflict):
        one.promote(1, last=seen[0])


def test_rows_without_a_test_split_are_rated_on_the_training_rows(spark):
    rows = [(f"user_{i}", float(i), float(i % 3)) for i in range(40)]
    frame = spark.createDataFrame(rows, "id string, x double, y double")
    split = an.train_test_split(frame, "id")
    assert an.evaluation_rows(split).count() == split.where("split = 'test'").count() > 0
    none = split.where("split = 'train'")
    assert an.evaluation_rows(none).count() == none.count()
    trial = an.ExcessMassTrial(frame.join(none.select("id"), "id"), "id", ["x", "y"], shared_dir(spark, "trial"), n_generated=500)
    row = trial.run("knn_k3", "knn", {"k": 3}).first()
    assert row["status"] == "FINISHED" and row["loss"] < 0


@pytest.mark.parametrize("seed", range(5))
def test_envelope_equals_every_line_at_every_grid_point(seed):
    rng = np.random.default_rng(seed)
    grid = np.arange(2000) * 0.01
    a, b = rng.random(400), rng.random(400)
    if seed % 2:
        a, b = np.sort(a), np.sort(b)                                         # the staircase of nested sets
        a[10:20], b[10:20] = a[10], b[10]
    kept = an.upper_envelope(a, b, grid)
    dense = (a[:, None] - b[:, None] * grid).max(0)
    assert np.allclose((a[kept, None] - b[kept, None] * grid).max(0), dense, rtol=0, atol=1e-12)
    parts = np.array_split(rng.permutation(400), 7)                           # envelopes of parts merge to the same
    merged = np.concatenate([p[an.upper_envelope(a[p], b[p], grid)] for p in parts])
    again = merged[an.upper_envelope(a[merged], b[merged], grid)]
    assert np.allclose((a[again, None] - b[again, None] * grid).max(0), dense, rtol=0, atol=1e-12)
    assert len(kept) <= len(grid)


def test_excess_mass_in_many_blocks(spark):
    rng = np.random.default_rng(4)
    x = spark.createDataFrame([(float(v),) for v in rng.normal(size=700)], "s double")
    u = spark.createDataFrame([(float(v),) for v in rng.uniform(-4, 4, size=900)], "s double")
    volume = spark.createDataFrame([(2.0,)], "volume double")
    one, many = (an.excess_mass(x, u, volume, t_steps=500, lines_per_block=n).first() for n in (10 ** 6, 40))
    assert one["k_max"] == many["k_max"] and one["em"] == pytest.approx(many["em"], rel=1e-12)


def test_production_model_is_loaded_not_searched_again(spark, lake):
    from tracewise.plans import registry_model as rm
    version, model = rm.production_model(lake)
    again, _ = rm.production_model(Lake(spark, SF))
    assert (version["version"], version["artefact"]) == (again["version"], again["artefact"])
    got = {r["user_id"]: r["score"] for r in rm.q_score_with_production_model(spark, SF).collect()}
    train = an.train_test_split(lake.training_table, "id").where("split = 'train'")
    want = an.score(lake.rolling_table, "user_id", FEATS, train, "id", model.detector, model.params)
    want = {r["user_id"]: r["score"] for r in want.select("user_id", F.round("score", 6).alias("score")).collect()}
    assert got and got == pytest.approx(want, abs=1e-6)
