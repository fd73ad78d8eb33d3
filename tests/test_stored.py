"""Stored tables: upserts in place, declared tables, table-to-table streams, day sketches."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tracewise.operators import sketches as sk
from tracewise.operators import stored
from tracewise.streaming.tables import run_table_to_table

SCHEMA = "id long, kind string, v string"


def files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")) for d in os.listdir(path) if "=" in d}


def put(spark, path, rows):
    stored.upsert_in_place(path, spark.createDataFrame(rows, SCHEMA), ["id", "kind"], ["kind"])


def table(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).select("id", "kind", "v").collect()), key=str)


def test_untouched_partitions_keep_their_files(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    put(spark, path, [(1, "a", "x"), (2, "a", "y"), (1, "b", "z"), (5, None, "n")])
    before = files(path)
    put(spark, path, [(2, "a", "new"), (3, "a", "added"), (3, "a", "added")])
    after = files(path)
    assert after["kind=b"] == before["kind=b"] and after["kind=a"] != before["kind=a"]
    want = [(1, "a", "x"), (1, "b", "z"), (2, "a", "new"), (3, "a", "added"), (5, None, "n")]
    assert table(spark, path) == sorted(want, key=str)
    put(spark, path, [(2, "a", "new"), (3, "a", "added")])                # a replay
    assert table(spark, path) == sorted(want, key=str)
    put(spark, path, [(5, None, "null key"), (6, "", "empty is null")])
    assert (5, None, "null key") in table(spark, path) and (6, None, "empty is null") in table(spark, path)
    put(spark, path, [])
    assert len(table(spark, path)) == 6 and not os.path.exists(f"{path}/_staged")


def test_a_run_lost_before_the_swap_is_finished(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    put(spark, path, [(1, "a", "x"), (1, "b", "y")])
    spark.createDataFrame([(1, "a", "staged")], SCHEMA).write.partitionBy("kind").parquet(f"{path}/_staged")
    assert (1, "a", "x") in table(spark, path)                            # readers do not see the stage
    put(spark, path, [(2, "b", "later")])
    assert table(spark, path) == [(1, "a", "staged"), (1, "b", "y"), (2, "b", "later")]


def test_partition_columns_belong_to_the_key(spark, tmp_dir):
    with pytest.raises(ValueError, match="among the keys"):
        stored.upsert_in_place(f"{tmp_dir}/t", spark.createDataFrame([(1, "a", "x")], SCHEMA), ["id"], ["kind"])


def test_declared_defaults_and_a_stream_between_tables(spark, tmp_dir):
    a, b = (f"{k}_{uuid.uuid4().hex[:8]}" for k in "ab")
    schema = spark.createDataFrame([], "id long, kind string, at timestamp, v string").schema
    stored.declare_table(spark, a, schema, f"{tmp_dir}/a", {"at": "current_timestamp()", "kind": "'none'"})
    stored.insert_by_name(spark.createDataFrame([("x", 1)], "v string, id long"), a)
    row = spark.table(a).first()
    assert (row["id"], row["kind"], row["v"]) == (1, "none", "x") and row["at"] is not None
    for n in (1, 2):
        run_table_to_table(spark, a, b, f"{tmp_dir}/progress", f"{tmp_dir}/b", lambda df: df.where("id is not null"))
        assert spark.table(b).count() == n
        stored.insert_by_name(spark.createDataFrame([(2, "k"), (None, "k")], "id long, kind string"), a)
    with pytest.raises(ValueError, match="no such columns"):
        stored.declare_table(spark, f"{a}_c", schema, f"{tmp_dir}/c", {"nowhere": "1"})


def test_merged_sketches_stay_within_their_bounds(spark):
    events = spark.range(60_000).select(
        (F.col("id") % 21_000).alias("user"), F.col("id").alias("n"), F.lit(None).cast("string").alias("nothing"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int") % 240)).alias("event_ts"))
    days = sk.day_sketches(events, ["user", "nothing", "event_ts"], ["n", "event_ts"])
    assert days.count() == 10 and "Expand" not in days._jdf.queryExecution().toString()
    for first, last, part in ((None, None, events), ("2024-01-03", "2024-01-05", events.where(
            "event_ts >= timestamp'2024-01-03' and event_ts < timestamp'2024-01-06'"))):
        one = sk.merged(days, first, last)
        got = {r["column"]: r["n_estimated"] for r in sk.distinct_estimates(one).collect()}
        direct = {r["column"]: r["n_estimated"] for r in sk.distinct_estimates(
            sk.merged(sk.day_sketches(part.withColumn("event_ts", F.lit("2024-01-01").cast("timestamp")), ["user"]))).collect()}
        exact = part.select("user").distinct().count()
        assert abs(got["user"] - exact) <= sk.DISTINCT_BOUND * exact and got["nothing"] == 0
        assert abs(got["user"] - direct["user"]) <= sk.DISTINCT_BOUND * exact
        total = part.count()
        for r in sk.quantile_estimates(one, [0.1, 0.5, 0.9]).where("column = 'n'").collect():
            assert abs(part.where(F.col("n") <= r["value"]).count() / total - r["share"]) <= sk.RANK_BOUND


def test_silver_in_place_equals_one_batch_of_all(spark, tmp_dir):
    from tracewise.operators.silver import silver_edges, silver_nodes
    from tracewise.operators.upsert import EDGE_KEYS, NODE_KEYS, NODE_ORDER, latest_per_key
    from tracewise.plans.lake import Lake
    from tracewise.streaming.tables import InPlaceSilverWriter
    bronze = Lake(spark, "/root/testdata/sf0.001").bronze
    halves = [bronze.where("id % 2 = 0"), bronze.where("id % 2 = 1")]
    writer = InPlaceSilverWriter(tmp_dir)
    for n, batch in enumerate([halves[0], halves[1], halves[0]]):
        writer(batch, n)
    for name, want in (("nodes", latest_per_key(silver_nodes(bronze), NODE_KEYS, NODE_ORDER)),
                       ("edges", latest_per_key(silver_edges(bronze), EDGE_KEYS))):
        key = NODE_KEYS if name == "nodes" else EDGE_KEYS
        got = spark.read.schema(want.schema).parquet(f"{tmp_dir}/{name}").select(*key)
        want = want.select(*key)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
