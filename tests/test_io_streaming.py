"""File sources, sinks, layouts and the streaming legs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tracewise.operators import layout as lay
from tracewise.operators.bronze import flatten_metadata
from tracewise.plans.lake import Lake
from tracewise.sources.fixtures import api_log_lines, raw_logs
from tracewise.sources.json_logs import read_raw_logs, to_json_lines
from tracewise.sources.text_logs import (
    clean_api_logs, line_count, parse_api_log_lines, read_api_log_files, read_text, split_outside_quotes,
)
from tracewise.streaming import medallion as med

SF = "/root/testdata/sf0.001"


def test_api_log_file_reader_matches_text_parser(spark, tmp_dir):
    lines = api_log_lines(spark, SF)
    path = os.path.join(tmp_dir, "logs")
    lines.write.mode("overwrite").text(path)
    from_files = clean_api_logs(read_api_log_files(spark, path))
    from_text = clean_api_logs(parse_api_log_lines(lines))
    assert sorted(from_files.collect()) == sorted(from_text.collect())
    assert line_count(read_text(spark, path)).first()[0] == lines.count()
    # A2 vs A4 parity (the source's own cross-check): same row count, same ip counts
    a4 = split_outside_quotes(read_text(spark, path))
    assert sorted(a4.groupBy("ip").count().collect()) == sorted(from_files.groupBy("ip").count().collect())


def test_json_reader_declared_schema_and_bad_line(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    to_json_lines(raw_logs(spark, SF)).write.mode("overwrite").text(path)
    with open(os.path.join(path, "bad.json"), "w") as fh:
        fh.write("{not json\n")
    df = read_raw_logs(spark, path)
    assert df.count() == 1001
    assert df.filter(F.col("id").isNull()).count() == 1
    assert df.schema["params"].dataType["itemSource"].dataType.typeName() == "long"


def test_partitioned_write_prunes_directories(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    lay.write_partitioned(Lake(spark, SF, materialize=False).bronze, path, ["entity_type", "role"])
    dirs = sorted(d for d in os.listdir(path) if d.startswith("entity_type="))
    assert dirs == ["entity_type=ip", "entity_type=name"]
    q = spark.read.parquet(path).filter((F.col("entity_type") == "name") & (F.col("role") == "staff"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(entity_type" in plan


def test_cluster_write_file_count_and_contents(spark, tmp_dir):
    b = Lake(spark, SF, materialize=False).bronze
    path = os.path.join(tmp_dir, "z")
    n = lay.cluster_write(b, path, ["event_ts", "entity_id"], source_bytes=100_000, mode="zorder", target_bytes=16 * 1024)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert n == 7 and 1 < len(files) <= n
    assert sorted(map(str, flatten_metadata(spark.read.parquet(path)).collect())) == sorted(map(str, flatten_metadata(b).collect()))


def test_whole_strings_are_ranked_and_cluster(spark, tmp_dir):
    edges = Lake(spark, "/root/testdata/sf0.01", materialize=False).edges.where("src is not null and dst is not null").persist()
    keyed, (rank, _) = lay._rank_columns(edges, ["src", "dst"], 8, 0.001)
    assert keyed.select(rank).distinct().count() >= 150
    bad = keyed.select("src", rank).distinct().groupBy("src").count().where("count > 1").count()
    pairs = [(r["src"], r[rank]) for r in keyed.select("src", rank).distinct().orderBy("src").collect()]
    assert bad == 0 and [r for _, r in pairs] == sorted(r for _, r in pairs)
    path = os.path.join(tmp_dir, "src_dst")
    lay.cluster_write(edges, path, ["src", "dst"], source_bytes=64, target_bytes=1)
    def files_per_src(df, file):
        return df.withColumn("_file", file).groupBy("src").agg(F.countDistinct("_file").alias("f"), F.count(F.lit(1)).alias("n")).where("n >= 20").agg(F.avg("f")).first()[0]
    laid, n_files = spark.read.parquet(path), len(spark.read.parquet(path).inputFiles())
    by_chance = files_per_src(edges, F.pmod(F.xxhash64("id", "event_ts"), F.lit(n_files)))
    assert n_files >= 12 and files_per_src(laid, F.input_file_name()) < 0.75 * by_chance
    edges.unpersist()


def test_hot_partition_value_is_split(spark, tmp_dir):
    df = spark.range(200_000).selectExpr("id", "IF(id % 10 < 6, 'hot', 'k' || (id % 10)) AS k", "md5(cast(id AS string)) AS body")
    plan = df.hint("rebalance", F.col("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        lay.write_partitioned(df, os.path.join(tmp_dir, "hot"), ["k"])
    finally:
        spark.conf.unset(key)
    hot = [f for f in os.listdir(os.path.join(tmp_dir, "hot", "k=hot")) if f.endswith(".parquet")]
    assert len(hot) > 1 and spark.read.parquet(os.path.join(tmp_dir, "hot")).count() == 200_000


def test_column_statistics(spark):
    b = Lake(spark, SF, materialize=False).bronze
    stats = {r["column_name"]: r for r in lay.column_statistics(b, ["entity_id", "event_ts"]).collect()}
    assert stats["entity_id"]["n_rows"] == 1000 and stats["entity_id"]["n_distinct"] == 15


def _bronze_via_stream(spark, tmp_dir, tag, n_files, per_trigger=1):
    raw_dir = os.path.join(tmp_dir, f"raw_{tag}")
    to_json_lines(raw_logs(spark, SF)).repartition(n_files).write.mode("overwrite").text(raw_dir)
    out, ckpt = os.path.join(tmp_dir, f"bronze_{tag}"), os.path.join(tmp_dir, f"ckpt_{tag}")
    med.run_raw_to_bronze(spark, raw_dir, out, ckpt, max_files_per_trigger=per_trigger)
    return raw_dir, out, ckpt


def test_stream_same_result_for_1_2_5_files_and_restart(spark, tmp_dir):
    results = []
    for n in (1, 2, 5):
        raw_dir, out, ckpt = _bronze_via_stream(spark, tmp_dir, str(n), n)
        results.append(sorted(flatten_metadata(spark.read.parquet(out)).collect()))
    assert results[0] == results[1] == results[2]
    before = spark.read.parquet(out).count()
    med.run_raw_to_bronze(spark, raw_dir, out, ckpt)   # restart from the checkpoint: nothing new
    assert spark.read.parquet(out).count() == before


def test_silver_micro_batch_replay_is_idempotent(spark, tmp_dir):
    _, bronze_dir, _ = _bronze_via_stream(spark, tmp_dir, "s", 3)
    root = os.path.join(tmp_dir, "silver")
    med.run_bronze_to_silver(spark, bronze_dir, root, os.path.join(tmp_dir, "ckpt_silver"), max_files_per_trigger=2)
    state = sorted(med.current_state(spark, root, "edges").collect())
    writer = med.SilverBatchWriter(root)
    writer(spark.read.parquet(bronze_dir).limit(50), 0)   # replay batch 0 with partial input
    bronze = spark.read.parquet(bronze_dir)
    writer(bronze, 0)                                     # and again with the full input
    assert sorted(med.current_state(spark, root, "edges").collect()) == state
    lake_edges = Lake(spark, SF, materialize=False).edges
    assert len(state) == lake_edges.count()
    # relationship is a folder of the table, so its filters read those folders alone
    plan = spark.read.parquet(f"{root}/edges").where("relationship = 'shared_link'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(relationship" in plan
    assert all(r["update_timestamp"] is not None for r in spark.read.parquet(f"{root}/nodes").collect())
    # folding again reads the base and what came after it; folded batches can go
    base = med.compact(spark, root, "edges", os.path.join(tmp_dir, "base0"), ["src", "dst"])
    newest = spark.read.parquet(f"{root}/edges").agg(F.max("batch_id")).first()[0]
    writer(bronze, newest + 1)
    again = med.compact(spark, root, "edges", os.path.join(tmp_dir, "base1"), ["src", "dst"], base_path=base)
    assert med.folded_up_to(spark, again) == newest + 1
    assert med.retire_folded(spark, root, "edges", again) == list(range(newest + 1))
    after = med.current_state(spark, root, "edges", base_path=again)
    keys = ["id", "event_ts", "relationship", "src", "dst"]
    assert sorted(map(str, after.select(*keys).collect())) == sorted(map(str, lake_edges.select(*keys).collect()))
    audit = med.load_audit(spark, root)
    assert audit.filter(F.col("rows_in") != F.col("rows_updated") + F.col("rows_inserted")).count() == 0


def test_full_refresh_switch(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw_fr")
    to_json_lines(raw_logs(spark, SF)).repartition(2).write.mode("overwrite").text(raw_dir)
    root = os.path.join(tmp_dir, "pipeline")
    first = med.PipelineRoot(spark, root)
    med.run_raw_to_bronze(spark, raw_dir, first.table("bronze"), first.checkpoint("bronze"))
    again = med.PipelineRoot(spark, root, full_refresh=False)
    assert again.generation == first.generation
    med.run_raw_to_bronze(spark, raw_dir, again.table("bronze"), again.checkpoint("bronze"))
    assert spark.read.parquet(again.table("bronze")).count() == 1000      # resumed: nothing new
    fresh = med.PipelineRoot(spark, root, full_refresh=True)
    assert fresh.generation == first.generation + 1
    med.run_raw_to_bronze(spark, raw_dir, fresh.table("bronze"), fresh.checkpoint("bronze"))
    assert spark.read.parquet(fresh.table("bronze")).count() == 1000      # reprocessed from scratch
    assert spark.read.parquet(first.table("bronze")).count() == 1000      # old generation untouched


def test_inference_over_time_ordered_files_and_replay(spark, tmp_dir):
    """Batches see nothing after their own last event, so feeding files in order or again gives the same rows."""
    from tracewise.operators import features as feat
    from tracewise.operators.silver import silver_edges
    b = Lake(spark, SF, materialize=False).bronze
    cut = F.to_timestamp(F.lit("2024-01-15 00:00:00"))
    feed, edges, folders = (os.path.join(tmp_dir, n) for n in ("feed", "edges", "folders"))
    for n, part in enumerate((b.where(F.col("event_ts") < cut), b.where(F.col("event_ts") >= cut))):
        part.coalesce(1).write.mode("append").parquet(feed)
    for n, name in enumerate(sorted((f for f in os.listdir(feed) if f.endswith(".parquet")),
                                    key=lambda f: spark.read.parquet(os.path.join(feed, f)).agg(F.max("event_ts")).first()[0])):
        os.utime(os.path.join(feed, name), (1_700_000_000 + n, 1_700_000_000 + n))
    silver_edges(b).write.parquet(edges)
    feat.top_in_degree(silver_edges(b)).write.parquet(folders)

    def scorer(frame):
        return frame.select("user_id", F.col("AvgLoginAttemptsPerDay").alias("score"))

    def run(tag):
        out = os.path.join(tmp_dir, f"out{tag}")
        med.run_stream_inference(spark, feed, edges, folders, scorer, out, os.path.join(tmp_dir, f"ck{tag}"), max_files_per_trigger=1)
        return sorted(map(str, spark.read.parquet(out).drop("prediction_timestamp").collect())), out
    rows, out = run("a")
    assert rows == run("b")[0]
    batches = spark.read.parquet(out)
    assert batches.select("batch_id").distinct().count() == 2
    rates = [c for c in batches.columns if c.endswith("PerDay")]
    assert batches.where(" or ".join(f"{c} < 0" for c in rates)).count() == 0


def test_later_events_do_not_change_a_window(spark):
    from tracewise.operators import features as feat
    import datetime as dt
    t = dt.datetime(2024, 1, 10)
    rows = [(1, t, "login_attempt", "a", "name"), (2, t - dt.timedelta(days=2), "login_failed", "a", "name")]
    later = [(3, t + dt.timedelta(days=n), "login_attempt", "a", "name") for n in (1, 4)]
    schema = "id long, event_ts timestamp, event_type string, entity_id string, entity_type string"
    batch, history = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + later, schema)
    for last in (None, t):
        window = feat.window_for_batch(batch, 7, last)
        got = feat.login_features(history, window=window).collect()
        assert [(r["LogDurationInDays"], r["TotalLoginAttempts"], r["TotalFailedAttempts"]) for r in got] == [(3, 1, 1)]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from tracewise.session import is_single_machine
    assert is_single_machine("local") and is_single_machine("local[8]")
    assert not is_single_machine("local-cluster[3,2,3000]") and not is_single_machine("yarn")
