"""Physical-plan checks: the properties the design relies on at scale."""

from __future__ import annotations

import re

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs(spark):
    import __spark_entry__ as entry
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # full scan metadata in plan text
    return entry.queries()


def test_lookup_filters_reach_the_scan(spark, qs):
    plan = _plan(qs["zorder_layout"](spark, SF))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "EqualTo(entity_id,u7)" in pushed and "GreaterThanOrEqual(event_ts" in pushed


def test_partition_predicates_prune_directories(spark, qs):
    plan = _plan(qs["partition_prune_scan"](spark, SF))
    assert "PartitionFilters: [" in plan and "(entity_type" in plan and "(role" in plan


def test_gold_plans_have_no_cartesian_product(spark, qs):
    for name in ["training_feature_frame", "rolling_feature_frame", "gold_sharing_features", "motif_reciprocal"]:
        plan = _plan(qs[name](spark, SF))
        assert "CartesianProduct" not in plan, name


def test_system_folders_are_broadcast_and_top_k_is_not_a_sort(spark, qs):
    plan = _plan(qs["gold_file_access_features"](spark, SF))
    assert "BroadcastHashJoin" in plan
    top = _plan(qs["system_folders_top10"](spark, SF))
    assert "TakeOrderedAndProject" in top and "Sort [" not in top.split("TakeOrderedAndProject")[1][:200]


def test_distinct_counts_are_two_stage_not_expand(spark, qs):
    plan = _plan(qs["gold_file_access_features"](spark, SF))
    assert "Expand" not in plan
    assert re.search(r"HashAggregate\(keys=\[src#\d+, id#\d+L?\]", plan)


def test_rolling_bounds_prune_the_bronze_scan(spark, qs):
    plan = _plan(qs["rolling_login_features"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(event_ts", plan)


def test_column_pruning_on_edge_scans(spark, qs):
    plan = _plan(qs["share_access_in_degree"](spark, SF))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("metadata" not in s or "itemSource" in s for s in scans)


def test_edge_jobs_build_without_writing(spark, qs, monkeypatch):
    from pyspark.sql import DataFrame
    written = []
    monkeypatch.setattr(DataFrame, "write", property(lambda self: written.append(1)))
    for name in ["file_edges", "share_access_in_degree", "failed_access_in_degree", "failed_share_in_degree", "shares_out_degree",
                 "share_degree", "gold_login_features", "active_batch_users", "default_timestamp_fill"]:
        qs[name](spark, SF)
    assert not written


def test_scans_open_files(spark, qs):
    for name, kind in [("scan_json_nested", "json"), ("log_scan_clean", "csv"), ("log_line_count", "text"), ("log_regex_split", "text")]:
        assert f"FileScan {kind}" in _plan(qs[name](spark, SF)), name


def test_point_lookup_is_pushed_to_the_written_table(spark, qs):
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", _plan(qs["entity_time_lookup"](spark, SF))).group(1)
    assert "EqualTo(entity_id,u7)" in pushed and "GreaterThanOrEqual(event_ts" in pushed


def test_common_values_are_not_shuffled(spark):
    from tracewise.operators import anomaly as an
    df = spark.createDataFrame([(i, 0.0 if i % 5 else float(i)) for i in range(500)], "id long, a double")
    plan = _plan(an.ecod_scores(df, "id", ["a"]))
    assert "BroadcastHashJoin" in plan
