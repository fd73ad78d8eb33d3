"""Day partials: any batch order and replay equals the full computation; a refresh reads only its users' folders."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tracewise.functions.vocabulary import LOGIN_TYPES, NAMED_ENTITY
from tracewise.operators import features as feat
from tracewise.plans.lake import Lake
from tracewise.session import shared_dir
from tracewise.streaming import partials as part

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF)


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1, 1]])
def test_any_order_and_replay_equal_the_full_computation(spark, lake, order):
    root = shared_dir(spark, "partials")
    write = part.PartialsBatchWriter(root)
    for n in order:
        write(lake.bronze_table.where(F.pmod(F.xxhash64("id", "event_ts"), F.lit(3)) == n), n)
    assert rows(part.merged_logins(part.stored(spark, root, "logins"))) == rows(feat.login_features(lake.bronze_table))
    files = part.merged_files(part.stored(spark, root, "files"), lake.system_folders)
    assert rows(files) == rows(feat.file_access_features(lake.edges, lake.system_folders))


def test_an_id_that_comes_again_counts_once(spark):
    ts = [datetime(2024, 1, d, 12) for d in (1, 2, 2)]
    edges = spark.createDataFrame([(7, ts[0], "file_written", "user_a", "f1"), (7, ts[1], "file_written", "user_a", "f1"), (8, ts[2], "file_written", "user_a", "f2")],
                                  "id long, event_ts timestamp, relationship string, src string, dst string")
    folders = spark.createDataFrame([("f1",)], "id string")
    parts = part.file_partials(edges.where("id = 7 and day(event_ts) = 1")).unionByName(part.file_partials(edges.where("not (id = 7 and day(event_ts) = 1)")))
    got, want = part.merged_files(parts, folders), feat.file_access_features(edges, folders)
    assert rows(got) == rows(want) and got.first()["NumTimesWrittenToSysFolder"] == 1


@pytest.mark.parametrize("lower,upper", [(None, "2024-01-15 10:30:00"), ("2024-01-10 07:00:00", "2024-01-15 10:30:00"),
                                         ("2024-01-15 07:00:00", "2024-01-15 10:30:00"), (None, "2024-01-15 00:00:00")])
def test_ranges_that_begin_and_end_inside_a_day(spark, lake, lower, upper):
    low, high = (None if x is None else datetime.fromisoformat(x) for x in (lower, upper))
    ev = lake.bronze_table.where(F.col("event_ts") <= F.lit(high))
    ev = ev if low is None else ev.where(F.col("event_ts") >= F.lit(low))
    got = part.in_range(part.login_partials(lake.bronze_table), lake.bronze_table, part.login_partials, low, high)
    assert rows(part.merged_logins(got)) == rows(feat.login_features(ev))


def test_a_refresh_reads_only_the_folders_of_its_users(spark, lake):
    root = shared_dir(spark, "partials")
    write = part.PartialsBatchWriter(root)
    write(lake.bronze_table, 0)
    logins = lake.bronze_table.where(F.col("event_type").isin(*LOGIN_TYPES) & (F.col("entity_type") == NAMED_ENTITY))
    user = logins.orderBy("entity_id").first()["entity_id"]
    one = logins.where(F.col("entity_id") == user)
    write(one.limit(3), 1)
    fresh = part.touched_logins(spark, root, [1])
    bucket = spark.range(1).select(part.user_bucket(F.lit(user))).first()[0]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ (= {bucket}|IN \({bucket}\))", plan)
    assert [r["entity_id"] for r in fresh.collect()] == [user]
