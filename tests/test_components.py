"""Connected components of graphs with hubs: labels against a union-find, and rows per task."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tracewise.operators import graph


def union_find(ids, pairs):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("share", [1, 500])
def test_stars_chains_and_loose_vertices(spark, monkeypatch, share):
    """``share`` 1: no vertex is a hub; 500: in so small a graph every vertex is one."""
    monkeypatch.setattr(graph, "HUB_SHARE", share)
    r = random.Random(2)
    pairs = [(0, i) for i in range(1, 300)] + [(999, i) for i in range(400, 600)] + [(i, i + 1) for i in range(700, 740)]
    pairs += [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(150)] + [(5, 5), (0, 1), (1, 0)]
    ids = list(range(1300))
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    e = spark.createDataFrame(pairs + [(3, 5000), (None, 4)], "src long, dst long")
    got = {x["id"]: x["component"] for x in graph.connected_components(v, e).collect()}
    assert got == union_find(ids, pairs)


@pytest.mark.parametrize("hub_is_small", [True, False])
def test_no_task_holds_a_hub(spark, hub_is_small):
    """A star with 60 % of the edges: after the join no partition has more than a few times the median."""
    hub = F.lit(-1 if hub_is_small else 10_000_000)
    star = spark.range(0, 60_000, 1, 8).select(hub.cast("long").alias("v"), F.col("id").alias("u"))
    rest = spark.range(0, 40_000, 1, 8).select((F.col("id") % 20_000).alias("v"), (F.col("id") + 100_000).alias("u"))
    rows = star.unionByName(rest)
    labels = rows.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n"))
    per = [r["count"] for r in graph._with_label(rows, labels, 100_000).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 100_000 and max(per) <= 4 * sorted(per)[len(per) // 2]


@pytest.mark.parametrize("share", [1, 500])
def test_labels_kept_over_batches_equal_a_full_run(spark, monkeypatch, share):
    """Three batches: a growing star, a chain that joins old components, repeats and edges to unknown ends."""
    monkeypatch.setattr(graph, "HUB_SHARE", share)
    r = random.Random(7)
    batches = [([(0, i) for i in range(1, 200)] + [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(90)], range(0, 500)),
               ([(i, i + 1) for i in range(600, 640)] + [(600, 300), (0, 1), (7, 7), (None, 3), (2, 9999)], range(400, 700)),
               ([(640, 5), (650, 651), (5, 640)], range(650, 652))]
    labels = spark.createDataFrame([], "id long, component long")
    seen_pairs, seen_ids = [], set()
    for pairs, ids in batches:
        v = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
        e = spark.createDataFrame(pairs, "src long, dst long")
        labels = graph.extend_components(labels, v, e)
        seen_ids |= set(ids)
        seen_pairs += [(a, b) for a, b in pairs if a is not None and a in seen_ids and b in seen_ids]
        rows = labels.collect()
        assert {x["id"]: x["component"] for x in rows} == union_find(seen_ids, seen_pairs) and len(rows) == len(seen_ids)
    if share == 500:
        assert sorted(graph.extend_components(labels, v, e).collect()) == sorted(rows)
        assert sorted(graph.extend_components(labels, v.limit(0), e.limit(0)).collect()) == sorted(rows)


def tasks_of(spark, group, job):
    """Tasks of all stages that ``job`` runs."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = job()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return out, sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)) is not None and i.numCompletedTasks)


def test_rounds_of_a_small_graph_run_few_tasks(spark):
    """A long chain of few edges, many shuffle partitions: a round has far fewer tasks than stages x partitions."""
    pairs = [(i, i + 1) for i in range(0, 3000)] + [(5000 + i % 7, 6000 + i) for i in range(500)]
    e = spark.createDataFrame(pairs, "src long, dst long")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        v = e.selectExpr("explode(array(src, dst)) as id").distinct()
        got, tasks = tasks_of(spark, "few-tasks", lambda: graph.connected_components(v, e).collect())
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)
    want = union_find({i for p in pairs for i in p}, pairs)
    assert {x["id"]: x["component"] for x in got} == want and len(got) == len(want)
    assert tasks < 10_000      # 5,763 on 8 cores; 30,245 when every stage had a task for each shuffle partition


@pytest.mark.parametrize("known", [True, False])
def test_no_task_holds_a_hub_when_ends_are_looked_up(spark, known):
    """A star with 60 % of the edges, its centre a vertex or not: the rows are not shuffled by it."""
    hub = 10_000_000
    star = spark.range(0, 60_000, 1, 8).select(F.lit(hub).cast("long").alias("hi"), F.col("id").alias("lo"))
    rest = spark.range(0, 40_000, 1, 8).select((F.col("id") % 20_000 + 200_000).alias("hi"), (F.col("id") + 100_000).alias("lo"))
    ids = spark.range(200_000, 220_000)
    ids = ids.unionByName(spark.range(hub, hub + 1)) if known else ids
    per = [r["count"] for r in graph._of_vertices(star.unionByName(rest), ids, 100_000).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == (100_000 if known else 40_000) and max(per) <= 4 * sorted(per)[len(per) // 2]


def test_edges_of_finished_rounds_are_deleted(spark):
    """Only the last round's edges stay below the shared folder."""
    import os

    from tracewise.session import ensure_checkpoint_dir
    at = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    there = {x for x in os.listdir(at) if x.startswith("component-edges")} if os.path.isdir(at) else set()
    e = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    found = graph.edge_components(e)
    assert {r["component"] for r in found.collect()} == {0} and found.count() == 201
    assert len({x for x in os.listdir(at) if x.startswith("component-edges")} - there) == 1


def test_loops_and_empty_edges(spark):
    """No edges, loops and null ends only, and stars already: labels without a round."""
    none = spark.createDataFrame([(3, 3), (None, 4), (5, None)], "src long, dst long")
    assert graph.edge_components(none).collect() == [] and graph.edge_components(none.limit(0)).collect() == []
    v = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    e = spark.createDataFrame([("b", "a"), ("a", "b"), ("c", "c"), ("b", "z")], "src string, dst string")
    assert sorted(map(tuple, graph.connected_components(v, e).collect()), key=str) == [("a", "a"), ("b", "a"), ("c", "c"), (None, None)]
