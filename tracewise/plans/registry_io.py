"""Queries over sinks, upserts, layouts and streams.

These jobs write into a fresh folder below the session's shared checkpoint
folder (``spark.checkpoint.dir``) and read the result back, so each call is
self-contained and replay-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from tracewise.operators import clustering as cl
from tracewise.operators import layout as lay
from tracewise.operators import sketches as sk
from tracewise.operators import stored
from tracewise.operators import upsert as up
from tracewise.operators.bronze import flatten_metadata
from tracewise.operators.logs import api_calls
from tracewise.operators.silver import silver_edges, silver_nodes
from tracewise.plans.catalog import query
from tracewise.plans.lake import Lake
from tracewise.plans.oracle_sql import CUT, edges_sql, nodes_sql, with_ctes
from tracewise.plans.registry import EDGE_COLS, FLAT_META, _clean_logs
from tracewise.session import path_bytes, shared_dir
from tracewise.sources.json_logs import to_json_lines
from tracewise.streaming import medallion as med
from tracewise.streaming.tables import run_table_to_table

EDGE_NAMES = [c.strip() for c in EDGE_COLS.split(",")]
BRONZE_FLAT = "id, event_ts, role, event_type, entity_id, entity_type, " + FLAT_META
UPSERT_FROM = f"{CUT} - INTERVAL 1 DAY"


def _split_bronze(lake: Lake):
    """Target = bronze before the cutoff; source = bronze from one day before it (overlap)."""
    b = lake.bronze
    cut = F.to_timestamp(F.lit(lake.cutoff))
    return b.filter(F.col("event_ts") < cut), b.filter(F.col("event_ts") >= cut - F.expr("INTERVAL 1 DAY"))


_SPLIT_CTES = [
    ("bronze_a", f"SELECT * FROM bronze WHERE event_ts < {CUT}"),
    ("bronze_b", f"SELECT * FROM bronze WHERE event_ts >= {UPSERT_FROM}"),
]


def _anti_union(keys: list[str], cols: str) -> str:
    match = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    return (f"SELECT {cols} FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE {match}) "
            f"UNION ALL SELECT {cols} FROM src")


@query("upsert_nodes", with_ctes(_anti_union(up.NODE_KEYS, "id, name, entity_type, entity_role"), "bronze", extra=[
    *_SPLIT_CTES,
    ("nodes_a", nodes_sql("bronze_a")), ("nodes_b", nodes_sql("bronze_b")),
    ("tgt", "SELECT id, name, entity_type, MAX(entity_role) AS entity_role FROM nodes_a GROUP BY 1, 2, 3"),
    ("src", "SELECT id, name, entity_type, MAX(entity_role) AS entity_role FROM nodes_b GROUP BY 1, 2, 3"),
]))
def q_upsert_nodes(spark, sf_dir):
    """B8 nodes: key (id, name, entity_type); two roles for one key -> greatest role."""
    a, b = _split_bronze(Lake(spark, sf_dir))
    target = up.latest_per_key(silver_nodes(a), up.NODE_KEYS, up.NODE_ORDER)
    return up.upsert(target, silver_nodes(b), up.NODE_KEYS, up.NODE_ORDER)


@query("upsert_edges", with_ctes(_anti_union(up.EDGE_KEYS, EDGE_COLS), "bronze", extra=[
    *_SPLIT_CTES, ("tgt", edges_sql("bronze_a")), ("src", edges_sql("bronze_b")),
]))
def q_upsert_edges(spark, sf_dir):
    """B8 edges: key (id, event_ts, relationship)."""
    a, b = _split_bronze(Lake(spark, sf_dir))
    return up.upsert(silver_edges(a), silver_edges(b), up.EDGE_KEYS)


@query("upsert_edges_in_place", with_ctes(_anti_union(up.EDGE_KEYS, EDGE_COLS), "bronze", extra=[
    *_SPLIT_CTES, ("tgt", edges_sql("bronze_a")), ("src", edges_sql("bronze_b")),
]))
def q_upsert_edges_in_place(spark, sf_dir):
    """B8 + J4: the stored edges, upserted where they are; the second batch is applied twice (a replay)."""
    a, b = _split_bronze(Lake(spark, sf_dir))
    path = shared_dir(spark, "edges_in_place")
    for batch in (a, b, b):
        stored.upsert_in_place(path, silver_edges(batch), up.EDGE_KEYS, ["relationship"])
    return spark.read.schema(silver_edges(a).schema).parquet(path).select(*EDGE_NAMES)


@query("declared_table_stream", with_ctes(f"SELECT {EDGE_COLS}, TRUE AS filled FROM edges", "edges"))
def q_declared_table_stream(spark, sf_dir):
    """B6 + A6 + J1: insert by name into a declared table whose default fills update_timestamp, then stream table to table."""
    edges, home = silver_edges(Lake(spark, sf_dir).bronze), shared_dir(spark, "declared")
    source, target = (f"{kind}_{home.rsplit('-', 1)[1]}" for kind in ("declared", "streamed"))
    stored.declare_table(spark, source, StructType(edges.schema.fields + [StructField("update_timestamp", TimestampType())]),
                         f"{home}/source", {"update_timestamp": "current_timestamp()"})
    stored.insert_by_name(edges, source)
    run_table_to_table(spark, source, target, f"{home}/progress", f"{home}/target")
    return spark.table(target).select(*EDGE_NAMES, F.col("update_timestamp").isNotNull().alias("filled"))


SKETCHED = ["id", "entity_id", "event_type", "event_ts"]


@query("sketch_profile", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS n_exact, TRUE AS within_bound FROM bronze" for c in SKETCHED), "bronze"))
def q_sketch_profile(spark, sf_dir):
    """F4 + C6: stored day sketches merged over all days, held against the exact distinct counts."""
    bronze, path = Lake(spark, sf_dir).bronze, shared_dir(spark, "day_sketches")
    sk.day_sketches(bronze, SKETCHED, ["event_ts"]).write.parquet(path)
    estimates = sk.distinct_estimates(sk.merged(spark.read.parquet(path)))
    exact = reduce(DataFrame.unionByName, [
        bronze.select(F.col(c).cast("string").alias("value")).where("value is not null").distinct()
        .agg(F.count(F.lit(1)).alias("n_exact")).select(F.lit(c).alias("column"), "n_exact") for c in SKETCHED])
    error = F.abs(F.col("n_estimated") - F.col("n_exact"))
    return exact.join(F.broadcast(estimates), "column").select(      # one row per sketched column
        "column", "n_exact", (error <= sk.DISTINCT_BOUND * F.col("n_exact")).alias("within_bound"))


@query("upsert_events", with_ctes(_anti_union(up.EVENT_KEYS, BRONZE_FLAT), "bronze", extra=[
    *_SPLIT_CTES, ("tgt", "SELECT * FROM bronze_a"), ("src", "SELECT * FROM bronze_b"),
]))
def q_upsert_events(spark, sf_dir):
    """B8 events: key (id, entity_id, event_ts), null-safe."""
    a, b = _split_bronze(Lake(spark, sf_dir))
    return flatten_metadata(up.upsert(a, b, up.EVENT_KEYS))


@query("empty_clone", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze WHERE 1 = 2", "bronze"))
def q_empty_clone(spark, sf_dir):
    """``WHERE 1=2`` clone of bronze's schema (0 rows, same columns)."""
    return up.empty_clone(flatten_metadata(Lake(spark, sf_dir).bronze))


@query("default_timestamp_fill", with_ctes("SELECT *, TRUE AS has_update_timestamp FROM node_table", "node_table"))
def q_default_timestamp_fill(spark, sf_dir):
    """Node rows with ``update_timestamp`` filled by the writer's clock (compared: that it is there)."""
    filled = up.with_default_now(Lake(spark, sf_dir).node_plan)
    return filled.select("id", "name", "entity_type", "entity_role", F.col("update_timestamp").isNotNull().alias("has_update_timestamp"))


# --------------------------------------------------------------------------- sinks


@query("sink_table_roundtrip", with_ctes("SELECT * FROM hist_login", "hist_login"))
def q_sink_table_roundtrip(spark, sf_dir):
    """B1 + B10 + A5: overwrite a catalogue table (data in the shared folder), read it back."""
    lake = Lake(spark, sf_dir)
    loc = shared_dir(spark, "db")
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tracewise LOCATION '{loc}'")
    spark.sql("USE tracewise")
    try:
        lake.login_plan.write.mode("overwrite").option("path", f"{loc}/gold_logins").saveAsTable("login_history")
        return spark.table("tracewise.login_history")
    finally:
        spark.catalog.setCurrentDatabase(before)


@query("sink_csv_roundtrip", with_ctes(
    "SELECT ip, COUNT(*) AS api_calls FROM api_logs GROUP BY ip", "api_logs"))
def q_sink_csv_roundtrip(spark, sf_dir):
    """B2: CSV overwrite (twice: the second replaces the first), read back typed."""
    path = shared_dir(spark, "csv")
    agg = api_calls(_clean_logs(spark, sf_dir), ["ip"])
    agg.write.mode("overwrite").csv(path)
    agg.write.mode("overwrite").csv(path)
    return spark.read.schema("ip string, api_calls bigint").csv(path)


@query("sink_text_roundtrip", with_ctes(
    "SELECT '(' || ip || ',' || status || ',' || COUNT(*) || ')' AS value FROM api_logs GROUP BY ip, status",
    "api_logs"))
def q_sink_text_roundtrip(spark, sf_dir):
    """Text save of ``(key,count)`` lines; ``overwrite`` replaces delete-then-save."""
    path = shared_dir(spark, "text")
    agg = api_calls(_clean_logs(spark, sf_dir), ["ip", "status"], "n")
    lines = agg.select(F.concat(F.lit("("), F.col("ip"), F.lit(","), F.col("status").cast("string"), F.lit(","),
                                F.col("n").cast("string"), F.lit(")")).alias("value"))
    lines.write.mode("overwrite").text(path)
    lines.write.mode("overwrite").text(path)
    return spark.read.text(path)


# --------------------------------------------------------------------------- layouts


def _write_partitioned_bronze(spark, sf_dir):
    path = shared_dir(spark, "bronze_logs")
    lay.write_partitioned(Lake(spark, sf_dir).bronze, path, ["entity_type", "role"])
    return path


@query("bronze_partitioned_ctas", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze", "bronze"))
def q_bronze_partitioned_ctas(spark, sf_dir):
    """B4 + C1: CTAS partitioned by (entity_type, role), read back whole."""
    return flatten_metadata(spark.read.parquet(_write_partitioned_bronze(spark, sf_dir)))


LOOKUP_SQL = ("WHERE entity_id = 'u7' AND event_ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' "
              "AND TIMESTAMP '2024-01-20 00:00:00'")


def _lookup(df):
    return df.filter((F.col("entity_id") == "u7") & F.col("event_ts").between(
        F.to_timestamp(F.lit("2024-01-05 00:00:00")), F.to_timestamp(F.lit("2024-01-20 00:00:00"))))


@query("partition_prune_scan", with_ctes(
    f"SELECT {BRONZE_FLAT} FROM bronze {LOOKUP_SQL} AND entity_type = 'name' AND role = 'staff'", "bronze"))
def q_partition_prune_scan(spark, sf_dir):
    """The lookup plus partition predicates; only one directory is listed and read."""
    t = spark.read.parquet(_write_partitioned_bronze(spark, sf_dir))
    t = t.filter((F.col("entity_type") == "name") & (F.col("role") == "staff"))
    return flatten_metadata(_lookup(t))


def _clustered_bronze(spark, sf_dir, mode, target_bytes=lay.DEFAULT_TARGET_BYTES):
    """A clustered copy of the written bronze table, in files of about ``target_bytes``."""
    source, path = shared_dir(spark, "bronze_source"), shared_dir(spark, f"bronze_{mode}")
    Lake(spark, sf_dir).bronze.write.mode("overwrite").parquet(source)
    lay.cluster_write(spark.read.parquet(source), path, ["event_ts", "entity_id"], path_bytes(spark, source), mode=mode,
                      target_bytes=target_bytes)
    return path


@query("zorder_layout", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze {LOOKUP_SQL}", "bronze"))
def q_zorder_layout(spark, sf_dir):
    """C2 + C4: Morton-clustered copy on (event_ts, entity_id); the lookup over it."""
    return flatten_metadata(_lookup(spark.read.parquet(_clustered_bronze(spark, sf_dir, "zorder"))))


@query("cluster_layout", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze", "bronze"))
def q_cluster_layout(spark, sf_dir):
    """C3 + B5: range-clustered copy; contents equal the source."""
    return flatten_metadata(spark.read.parquet(_clustered_bronze(spark, sf_dir, "range")))


@query("clustered_loads", with_ctes(_anti_union(up.EVENT_KEYS, BRONZE_FLAT), "bronze", extra=[
    *_SPLIT_CTES, ("tgt", "SELECT * FROM bronze_a"), ("src", "SELECT * FROM bronze_b")]))
def q_clustered_loads(spark, sf_dir):
    """Hilbert pieces declared over the rows before the cutoff; the later ones rewrite only the pieces they fall into."""
    old, new = _split_bronze(Lake(spark, sf_dir))
    source, path = shared_dir(spark, "clustered_source"), shared_dir(spark, "clustered_bronze")
    old.write.mode("overwrite").parquet(source)
    size = path_bytes(spark, source)
    cl.declare_clustering(spark.read.schema(old.schema).parquet(source), path, ["event_ts", "entity_id"], size, target_bytes=128 * 1024)
    cl.load_clustered(path, new, up.EVENT_KEYS)
    return flatten_metadata(cl.read_clustered(spark, path))


@query("column_statistics", with_ctes(
    "SELECT 'entity_id' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(entity_id) AS n_nulls, "
    "COUNT(DISTINCT entity_id) AS n_distinct, MIN(entity_id) AS min_value, MAX(entity_id) AS max_value FROM bronze "
    "UNION ALL SELECT 'event_ts', COUNT(*), COUNT(*) - COUNT(event_ts), COUNT(DISTINCT event_ts), "
    "CAST(MIN(event_ts) AS VARCHAR), CAST(MAX(event_ts) AS VARCHAR) FROM bronze", "bronze"))
def q_column_statistics(spark, sf_dir):
    """C6."""
    return lay.column_statistics(Lake(spark, sf_dir).bronze, ["entity_id", "event_ts"])


# --------------------------------------------------------------------------- streams


MICRO_BATCH = 4 * 2 ** 30   # input bytes per micro-batch


def _raw_json_files(spark, sf_dir):
    """Raw log as JSON-lines files (the stream's source), derived from ``events``."""
    path = shared_dir(spark, "raw_json")
    to_json_lines(Lake(spark, sf_dir).raw).write.mode("overwrite").text(path)
    return path


def _stream_bronze(spark, sf_dir):
    raw = _raw_json_files(spark, sf_dir)
    out, ckpt = shared_dir(spark, "bronze_stream"), shared_dir(spark, "ckpt_bronze")
    med.run_raw_to_bronze(spark, raw, out, ckpt, max_bytes_per_trigger=MICRO_BATCH)
    return out


@query("stream_raw_to_bronze", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze", "bronze"))
def q_stream_raw_to_bronze(spark, sf_dir):
    """JSON files -> bronze parquet in micro-batches, then read the sink."""
    return flatten_metadata(spark.read.parquet(_stream_bronze(spark, sf_dir)))


def _stream_silver(spark, sf_dir):
    bronze = _stream_bronze(spark, sf_dir)
    root, ckpt = shared_dir(spark, "silver"), shared_dir(spark, "ckpt_silver")
    med.run_bronze_to_silver(spark, bronze, root, ckpt, max_bytes_per_trigger=MICRO_BATCH)
    return root


@query("stream_bronze_to_silver", with_ctes(f"SELECT {EDGE_COLS} FROM edges", "edges"))
def q_stream_bronze_to_silver(spark, sf_dir):
    """J4 + B8 (streaming form): per-batch directories, current state = latest per key."""
    return med.current_state(spark, _stream_silver(spark, sf_dir), "edges").select(*EDGE_NAMES)


@query("stream_silver_nodes", with_ctes("SELECT * FROM node_table", "node_table"))
def q_stream_silver_nodes(spark, sf_dir):
    """The node table as maintained by the micro-batches."""
    return med.current_state(spark, _stream_silver(spark, sf_dir), "nodes").select("id", "name", "entity_type", "entity_role")


@query("stream_silver_events", with_ctes(f"SELECT {BRONZE_FLAT} FROM bronze", "bronze"))
def q_stream_silver_events(spark, sf_dir):
    """The event table as maintained by the micro-batches."""
    return flatten_metadata(med.current_state(spark, _stream_silver(spark, sf_dir), "events").drop("update_timestamp"))


@query("upsert_compaction", with_ctes(f"SELECT {EDGE_COLS} FROM edges", "edges"))
def q_upsert_compaction(spark, sf_dir):
    """Fold all batches into one clustered base; state read through the base."""
    root = _stream_silver(spark, sf_dir)
    base = med.compact(spark, root, "edges", shared_dir(spark, "edges_base"), ["src", "dst", "event_ts"])
    return med.current_state(spark, root, "edges", base_path=base).select(*EDGE_NAMES)


@query("load_audit", with_ctes(
    "SELECT 'nodes' AS table_name, COUNT(*) AS rows_inserted FROM node_table UNION ALL "
    "SELECT 'edges', COUNT(*) FROM (SELECT DISTINCT id, event_ts, relationship FROM edges) UNION ALL "
    "SELECT 'events', COUNT(*) FROM (SELECT DISTINCT id, entity_id, event_ts FROM bronze)", "edges", "node_table"))
def q_load_audit(spark, sf_dir):
    """One row per table and micro-batch; their inserts add up to the table's keys."""
    audit = med.load_audit(spark, _stream_silver(spark, sf_dir))
    return audit.groupBy("table_name").agg(F.sum("rows_inserted").alias("rows_inserted"))
