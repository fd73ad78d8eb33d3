"""Named queries: ``(spark, sf_dir) -> DataFrame`` plus their DuckDB oracle SQL.

Every query reads the driver's tables (or frames Spark derives from them) in
full. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.functions.scalar import register_sql_functions, root_segment
from tracewise.functions.vocabulary import FEATURES
from tracewise.operators import bronze as br
from tracewise.operators import features as feat
from tracewise.operators import graph as gr
from tracewise.operators import logs as lg
from tracewise.operators import profile as pf
from tracewise.plans.catalog import query
from tracewise.plans.lake import Lake
from tracewise.plans.oracle_sql import SHARES, with_ctes
from tracewise.session import shared_dir
from tracewise.sources import json_logs, text_logs

FEATURE_LIST = ", ".join(FEATURES)
FLAT_META = ("errorCode, itemSource, itemType, newpath, oldpath, path, run, token, \"trigger\", uidOwner, \"user\"")

# --------------------------------------------------------------------------- sources / logs


def _api_files(spark, sf_dir):
    """The access log as text files in the shared folder, as many as the scan has tasks."""
    path = shared_dir(spark, "api_log")
    Lake(spark, sf_dir).api_lines.write.mode("overwrite").text(path)
    return path


@query("scan_json_nested", with_ctes(
    "SELECT id, isLocalIP, role, time, type, uid, uidType, " + FLAT_META + " FROM raw", "raw"))
def q_scan_json_nested(spark, sf_dir):
    """A1: JSON-lines files with a nested struct, read under the declared schema."""
    path = shared_dir(spark, "raw_log")
    json_logs.to_json_lines(Lake(spark, sf_dir).raw).write.mode("overwrite").text(path)
    return json_logs.flatten_params(json_logs.read_raw_logs(spark, path))


API_CLEAN_COLS = "ip, mac, user_id, timestamp_raw, timezone, api_call, status, code"


@query("log_scan_clean", with_ctes(f"SELECT {API_CLEAN_COLS} FROM api_logs", "api_logs"))
def q_log_scan_clean(spark, sf_dir):
    """A2 + D2: blank-separated quoted files through the CSV reader -> 8 typed columns."""
    return text_logs.clean_api_logs(text_logs.read_api_log_files(spark, _api_files(spark, sf_dir)))


@query("log_line_count", "SELECT COUNT(*) AS n_lines FROM events")
def q_log_line_count(spark, sf_dir):
    """Lines of the text files."""
    return text_logs.line_count(text_logs.read_text(spark, _api_files(spark, sf_dir)))


@query("log_regex_split", with_ctes(
    "SELECT ip, mac, user_id, timestamp_raw, timezone || ']' AS timezone_raw, '\"' || api_call || '\"' AS api_call, "
    "status, code FROM api_logs", "api_logs"))
def q_log_regex_split(spark, sf_dir):
    """A4: the text files' fields between blanks outside quotes; quotes and ']' kept."""
    return text_logs.split_outside_quotes(text_logs.read_text(spark, _api_files(spark, sf_dir)))


@query("root_folder_extract", with_ctes(
    "SELECT id, path, CASE WHEN starts_with(path, '/') THEN split_part(path, '/', 2) ELSE split_part(path, '/', 1) END "
    "AS root_folder FROM bronze WHERE length(path) > 1", "bronze"))
def q_root_folder_extract(spark, sf_dir):
    """Split and length: the first folder of a path, with or without a leading slash."""
    b = Lake(spark, sf_dir).bronze
    path = F.col("metadata.path")
    return b.filter(F.length(path) > 1).select("id", path.alias("path"), root_segment(path).alias("root_folder"))


def _clean_logs(spark, sf_dir):
    lines = Lake(spark, sf_dir).api_lines
    return text_logs.clean_api_logs(text_logs.parse_api_log_lines(lines))


@query("api_calls_by_ip", with_ctes(
    "SELECT ip, COUNT(*) AS api_calls FROM api_logs GROUP BY ip", "api_logs"))
def q_api_calls_by_ip(spark, sf_dir):
    return lg.api_calls(_clean_logs(spark, sf_dir), ["ip"])


@query("api_calls_by_ip_status", with_ctes(
    "SELECT ip, status, COUNT(*) AS api_calls_by_status FROM api_logs GROUP BY ip, status", "api_logs"))
def q_api_calls_by_ip_status(spark, sf_dir):
    return lg.api_calls(_clean_logs(spark, sf_dir), ["ip", "status"], "api_calls_by_status")


@query("replicate_union_all", with_ctes(
    "SELECT ip, COUNT(*) AS api_calls FROM api_logs, range(10) GROUP BY ip", "api_logs"))
def q_replicate_union_all(spark, sf_dir):
    """H1: ten copies of the cleaned log from one scan, then calls per ip."""
    return lg.api_calls(lg.replicate(_clean_logs(spark, sf_dir), 10), ["ip"])


_CLEAN_TS_SQL = with_ctes(
    f"SELECT {API_CLEAN_COLS}, strftime(date_trunc('second', _ts), '%Y-%m-%dT%H:%M:%S') AS clean_ts FROM api_logs",
    "api_logs")


@query("clean_timestamp", _CLEAN_TS_SQL)
def q_clean_timestamp(spark, sf_dir):
    """K1: the registered SQL function called by name on a frame, native expression underneath."""
    register_sql_functions(spark)
    return _clean_logs(spark, sf_dir).withColumn("clean_ts", F.call_function("cleanTimestamp", F.col("timestamp_raw")))


@query("clean_timestamp_udf", _CLEAN_TS_SQL)
def q_clean_timestamp_udf(spark, sf_dir):
    """K2: the Arrow-batched Python twin (slow path, kept for comparison)."""
    return lg.with_clean_timestamp(_clean_logs(spark, sf_dir), python=True)


PIVOT_DATES = [f"2024-01-{d:02d}" for d in range(1, 32)]
_PIVOT_COLS = ", ".join(f"MIN(user_id) FILTER (WHERE d = '{d}') AS \"{d}\"" for d in PIVOT_DATES)


@query("pivot_user_by_date", with_ctes(
    f"SELECT ip, clean_ts, {_PIVOT_COLS}, COUNT(*) FILTER (WHERE d NOT BETWEEN '{PIVOT_DATES[0]}' AND '{PIVOT_DATES[-1]}') "
    "AS n_other_dates FROM (SELECT ip, strftime(date_trunc('second', _ts), '%Y-%m-%dT%H:%M:%S') AS clean_ts, "
    "CAST(CAST(_ts AS DATE) AS VARCHAR) AS d, user_id FROM api_logs) t GROUP BY ip, clean_ts", "api_logs"))
def q_pivot_user_by_date(spark, sf_dir):
    """(ip, clean_ts) x the dates of a month, cell = user id; rows of other dates are counted."""
    logs = lg.with_clean_timestamp(_clean_logs(spark, sf_dir))
    dated = logs.withColumn("date", F.substring("clean_ts", 1, 10))
    return lg.pivot_min(dated, ["ip", "clean_ts"], "date", PIVOT_DATES, "user_id")


# --------------------------------------------------------------------------- bronze / silver


@query("bronze_projection", with_ctes(
    "SELECT id, event_ts, role, event_type, entity_id, entity_type, " + FLAT_META + " FROM bronze", "bronze"))
def q_bronze_projection(spark, sf_dir):
    """Raw -> bronze, with the struct kept (flattened here for comparison)."""
    return br.flatten_metadata(Lake(spark, sf_dir).bronze)


@query("nested_field_projection", with_ctes(
    "SELECT id, itemSource, itemType, token, uidOwner, errorCode FROM bronze WHERE itemSource IS NOT NULL", "bronze"))
def q_nested_field_projection(spark, sf_dir):
    """Dotted access into the nested struct, predicate on a nested field."""
    b = Lake(spark, sf_dir).bronze
    return (b.filter(F.col("metadata.itemSource").isNotNull())
            .select("id", F.col("metadata.itemSource").alias("itemSource"), F.col("metadata.itemType").alias("itemType"),
                    F.col("metadata.token").alias("token"), F.col("metadata.uidOwner").alias("uidOwner"),
                    F.col("metadata.errorCode").alias("errorCode")))


@query("entity_time_lookup", with_ctes(
    "SELECT id, event_ts, role, event_type, entity_id, entity_type, " + FLAT_META + " FROM bronze "
    "WHERE entity_id = 'u7' AND event_ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'",
    "bronze"))
def q_entity_time_lookup(spark, sf_dir):
    """Point lookup + time range."""
    b = Lake(spark, sf_dir).bronze_table       # the written table: both filters reach its scan
    return br.flatten_metadata(br.entity_time_lookup(b, "u7", "2024-01-05 00:00:00", "2024-01-20 00:00:00"))


@query("cardinality_profile", with_ctes(
    "SELECT COUNT(DISTINCT id) AS n_id, COUNT(DISTINCT ts) AS n_time, COUNT(DISTINCT role) AS n_role, "
    "COUNT(DISTINCT type) AS n_type, COUNT(DISTINCT uid) AS n_uid, COUNT(DISTINCT uidType) AS n_uid_type FROM raw",
    "raw"))
def q_cardinality_profile(spark, sf_dir):
    """F4."""
    return pf.cardinality_profile(Lake(spark, sf_dir).raw)


@query("events_per_entity", with_ctes(
    "SELECT entity_id, COUNT(*) AS num_events FROM bronze GROUP BY entity_id", "bronze"))
def q_events_per_entity(spark, sf_dir):
    """F5 (+ G1 order)."""
    return pf.events_per_entity(Lake(spark, sf_dir).bronze)


@query("events_per_month", with_ctes(
    "SELECT date_trunc('month', event_ts) AS event_month, COUNT(*) AS event_count FROM bronze GROUP BY 1", "bronze"))
def q_events_per_month(spark, sf_dir):
    """F6."""
    return pf.events_per_month(Lake(spark, sf_dir).bronze)


@query("events_per_day_in_month", with_ctes(
    "SELECT date_trunc('day', event_ts) AS event_day, COUNT(*) AS event_count FROM bronze "
    "WHERE date_trunc('month', event_ts) = TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1", "bronze"))
def q_events_per_day_in_month(spark, sf_dir):
    """F7 with the month as a parameter (T5)."""
    return pf.events_per_day_in_month(Lake(spark, sf_dir).bronze, "2024-01-01 00:00:00")


NODE_COLS = "id, name, entity_type, entity_role"
EDGE_COLS = "id, event_ts, relationship, src, dst, entity_sub_relationship, item_type_shared, status"


@query("silver_nodes", with_ctes(f"SELECT {NODE_COLS} FROM nodes", "nodes"))
def q_silver_nodes(spark, sf_dir):
    """H2."""
    return Lake(spark, sf_dir).nodes


@query("silver_edges", with_ctes(f"SELECT {EDGE_COLS} FROM edges", "edges"))
def q_silver_edges(spark, sf_dir):
    """H3."""
    return Lake(spark, sf_dir).edges_lazy


@query("active_batch_users", with_ctes("SELECT entity_id FROM batch_users", "batch_users"))
def q_active_batch_users(spark, sf_dir):
    """H4."""
    return Lake(spark, sf_dir).batch_users_plan


@query("relationship_profile", with_ctes(
    "SELECT relationship, COUNT(*) AS events FROM edges GROUP BY relationship", "edges"))
def q_relationship_profile(spark, sf_dir):
    """F12."""
    return pf.relationship_profile(Lake(spark, sf_dir).edges_lazy)


# --------------------------------------------------------------------------- gold


@query("gold_login_features", with_ctes("SELECT * FROM hist_login", "hist_login"))
def q_gold_login_features(spark, sf_dir):
    """F8."""
    return Lake(spark, sf_dir).login_plan


@query("system_folders_top10", with_ctes("SELECT * FROM sysf", "sysf"))
def q_system_folders_top10(spark, sf_dir):
    """F9 / G2."""
    return Lake(spark, sf_dir).system_folders


@query("gold_file_access_features", with_ctes("SELECT * FROM hist_files", "hist_files"))
def q_gold_file_access_features(spark, sf_dir):
    """F10 + E1."""
    return Lake(spark, sf_dir).hist_files


@query("gold_sharing_features", with_ctes("SELECT * FROM hist_sharing", "hist_sharing"))
def q_gold_sharing_features(spark, sf_dir):
    """F11 + E2."""
    return Lake(spark, sf_dir).hist_sharing


@query("reciprocal_shares", with_ctes(
    "SELECT DISTINCT e.src AS src, e2.id AS access_id FROM hist_edges e JOIN hist_edges e2 "
    "ON e.entity_sub_relationship = e2.dst AND e2.relationship = 'public_share_accessed' AND e2.src = e.dst "
    f"WHERE e.relationship IN {SHARES}", "hist_edges"))
def q_reciprocal_shares(spark, sf_dir):
    """(owner, access) pairs of the share self-join, up to the cutoff."""
    lake = Lake(spark, sf_dir)
    e = lake.edges.filter(F.col("event_ts") <= F.to_timestamp(F.lit(lake.cutoff)))
    return feat.reciprocal_access_ids(e.filter(F.col("relationship").isin("shared_link", "public_share_accessed")), e)


@query("training_feature_frame", with_ctes("SELECT * FROM training_frame", "training_frame"))
def q_training_feature_frame(spark, sf_dir):
    """E3 + M1 + D13."""
    return Lake(spark, sf_dir).training_frame


@query("feature_fillna", with_ctes(
    "SELECT * FROM training_frame WHERE AvgLoginAttemptsPerDay = 0 OR NumFilesSharedPerDay = 0", "training_frame"))
def q_feature_fillna(spark, sf_dir):
    """Rows where a missing feature became 0."""
    tf = Lake(spark, sf_dir).training_frame
    return tf.filter((F.col("AvgLoginAttemptsPerDay") == 0) | (F.col("NumFilesSharedPerDay") == 0))


@query("feature_non_null_counts", with_ctes(
    "SELECT COUNT(id) AS id, " + ", ".join(f"COUNT({c}) AS {c}" for c in FEATURES) + " FROM training_frame",
    "training_frame"))
def q_feature_non_null_counts(spark, sf_dir):
    """F18."""
    return feat.feature_non_null_counts(Lake(spark, sf_dir).training_frame)


@query("rolling_login_features", with_ctes("SELECT * FROM roll_login", "roll_login"))
def q_rolling_login_features(spark, sf_dir):
    """F13 + E5."""
    return Lake(spark, sf_dir).roll_login


@query("rolling_file_access_features", with_ctes("SELECT * FROM roll_files", "roll_files"))
def q_rolling_file_access_features(spark, sf_dir):
    """F14."""
    return Lake(spark, sf_dir).roll_files


@query("rolling_sharing_features", with_ctes("SELECT * FROM roll_sharing", "roll_sharing"))
def q_rolling_sharing_features(spark, sf_dir):
    """F15."""
    return Lake(spark, sf_dir).roll_sharing


@query("rolling_feature_frame", with_ctes("SELECT * FROM rolling_frame", "rolling_frame"))
def q_rolling_feature_frame(spark, sf_dir):
    """E4."""
    return Lake(spark, sf_dir).rolling_frame


@query("active_user_edges", with_ctes(f"SELECT {EDGE_COLS} FROM r_edges", "r_edges"))
def q_active_user_edges(spark, sf_dir):
    """E5."""
    lake = Lake(spark, sf_dir)
    return feat.active_user_edges(lake.edges_lazy, lake.window)


@query("failed_logins_7_14_30", with_ctes(
    "SELECT entity_id, "
    "COUNT(CASE WHEN event_ts >= b.max_ts - INTERVAL 7 DAY THEN 1 END) AS failed_7d, "
    "COUNT(CASE WHEN event_ts >= b.max_ts - INTERVAL 14 DAY THEN 1 END) AS failed_14d, "
    "COUNT(CASE WHEN event_ts >= b.max_ts - INTERVAL 30 DAY THEN 1 END) AS failed_30d "
    "FROM bronze, bounds b WHERE entity_type = 'name' AND event_type = 'login_failed' "
    "AND event_ts >= b.max_ts - INTERVAL 30 DAY GROUP BY entity_id", "bronze", "bounds"))
def q_failed_logins_7_14_30(spark, sf_dir):
    """Failed logins over the last 7, 14 and 30 days before the batch's last event."""
    lake = Lake(spark, sf_dir)
    return feat.failed_login_momentum(lake.bronze_table, lake.window.bounds, (7, 14, 30), lake.batch_start)


# --------------------------------------------------------------------------- graph


@query("file_edges", with_ctes(f"SELECT {EDGE_COLS} FROM edges WHERE relationship LIKE 'file%'", "edges"))
def q_file_edges(spark, sf_dir):
    """L2."""
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges("relationship LIKE 'file%'").edges


def _deg_sql(where: str, end: str, name: str) -> str:
    return with_ctes(f"SELECT {end} AS id, CAST(COUNT(*) AS INTEGER) AS {name} FROM edges "
                     f"WHERE {where} AND {end} IS NOT NULL GROUP BY {end}", "edges")


@query("share_access_in_degree", _deg_sql("relationship IN ('public_share_accessed')", "dst", "inDegree"))
def q_share_access_in_degree(spark, sf_dir):
    """L3."""
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges("relationship IN ('public_share_accessed')").in_degrees


@query("failed_access_in_degree", _deg_sql(
    "relationship IN ('public_share_accessed') AND status != 'success'", "dst", "inDegree"))
def q_failed_access_in_degree(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges(
        "relationship IN ('public_share_accessed') AND status != 'success'").in_degrees


@query("failed_share_in_degree", _deg_sql(
    "relationship IN ('shared_link') AND status != 'success'", "dst", "inDegree"))
def q_failed_share_in_degree(spark, sf_dir):
    """Per share object, as in the source."""
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges(
        "relationship IN ('shared_link') AND status != 'success'").in_degrees


@query("shares_out_degree", _deg_sql("relationship IN ('shared_link')", "src", "outDegree"))
def q_shares_out_degree(spark, sf_dir):
    """L4."""
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges("relationship IN ('shared_link')").out_degrees


@query("share_degree", with_ctes(
    "SELECT id, CAST(COUNT(*) AS INTEGER) AS degree FROM ("
    f"SELECT src AS id FROM edges WHERE relationship IN {SHARES} UNION ALL "
    f"SELECT dst FROM edges WHERE relationship IN {SHARES}) t WHERE id IS NOT NULL GROUP BY id", "edges"))
def q_share_degree(spark, sf_dir):
    """L5."""
    lake = Lake(spark, sf_dir)
    return gr.Graph(None, lake.edges_lazy).filter_edges(
        "relationship IN ('shared_link', 'public_share_accessed')").degrees


_VIDS = "(SELECT DISTINCT id FROM node_table)"


@query("motif_reciprocal", with_ctes(
    "SELECT e.src AS a_id, e.id AS e_id, e.relationship AS e_relationship, e.dst AS b_id, "
    "e2.id AS e2_id, e2.relationship AS e2_relationship FROM edges e JOIN edges e2 "
    "ON e.dst = e2.src AND e.src = e2.dst "
    f"WHERE e.src IN {_VIDS} AND e.dst IN {_VIDS}", "edges", "node_table"))
def q_motif_reciprocal(spark, sf_dir):
    """L6 (a)-[e]->(b); (b)-[e2]->(a)."""
    lake = Lake(spark, sf_dir)
    return gr.motif_reciprocal(lake.vertices, lake.edges)


@query("motif_single_edge", with_ctes(
    "SELECT a.id AS a_id, a.entity_type AS a_entity_type, e.id AS e_id, e.relationship AS e_relationship, "
    "e.event_ts AS e_event_ts, b.id AS b_id, b.entity_type AS b_entity_type FROM edges e "
    "JOIN (SELECT id, MIN(entity_type) AS entity_type FROM node_table GROUP BY id) a ON e.src = a.id "
    "JOIN (SELECT id, MIN(entity_type) AS entity_type FROM node_table GROUP BY id) b ON e.dst = b.id",
    "edges", "node_table"))
def q_motif_single_edge(spark, sf_dir):
    """L6 (a)-[e]->(b)."""
    lake = Lake(spark, sf_dir)
    return gr.motif_single_edge(lake.vertices, lake.edges)


@query("reciprocal_pair_counts", with_ctes(
    "SELECT e.src AS a_id, e.dst AS b_id, COUNT(*) AS n_pairs FROM edges e JOIN edges e2 "
    "ON e.dst = e2.src AND e.src = e2.dst GROUP BY e.src, e.dst", "edges"))
def q_reciprocal_pair_counts(spark, sf_dir):
    """L6 summary: (e, e2) pairs per directed vertex pair, without materialising them."""
    return gr.reciprocal_pair_counts(Lake(spark, sf_dir).edges)


_COMPONENTS_SQL = with_ctes(
    "SELECT s AS id, MIN(t) AS component FROM reach GROUP BY s", "edges", "node_table", recursive=True, extra=[
        ("v", "SELECT DISTINCT id FROM node_table"),
        ("und", "SELECT e.src AS a, e.dst AS b FROM edges e WHERE e.src IN (SELECT id FROM v) "
                "AND e.dst IN (SELECT id FROM v) UNION SELECT e.dst, e.src FROM edges e "
                "WHERE e.src IN (SELECT id FROM v) AND e.dst IN (SELECT id FROM v)"),
        ("reach", "SELECT id AS s, id AS t FROM v UNION SELECT r.s, u.b FROM reach r JOIN und u ON r.t = u.a"),
    ])


@query("connected_components", _COMPONENTS_SQL)
def q_connected_components(spark, sf_dir):
    """label = smallest vertex id of the component."""
    lake = Lake(spark, sf_dir)
    return gr.connected_components(lake.vertices.select("id"), lake.edges)


@query("components_incremental", _COMPONENTS_SQL)
def q_components_incremental(spark, sf_dir):
    """Labels of the edges before the cutoff are stored; those after it are folded in without reading the old ones."""
    lake = Lake(spark, sf_dir)
    ids, cut = lake.vertices.select("id"), F.to_timestamp(F.lit(lake.cutoff))
    path = shared_dir(spark, "component_labels")
    gr.connected_components(ids, lake.edges.where(F.col("event_ts") < cut)).write.mode("overwrite").parquet(path)
    return gr.extend_components(spark.read.parquet(path), ids, lake.edges.where(F.col("event_ts") >= cut))


@query("neighbor_avg_degree", with_ctes(
    "SELECT nb.id AS id, AVG(deg.degree) AS avg_neighbor_degree FROM nb JOIN deg ON nb.nb = deg.id "
    "WHERE nb.id LIKE 'user_%' GROUP BY nb.id", "edges", extra=[
        ("deg", "SELECT id, COUNT(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) t "
                "WHERE id IS NOT NULL GROUP BY id"),
        ("nb", "SELECT src AS id, dst AS nb FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL "
               "UNION ALL SELECT dst, src FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL"),
    ]))
def q_neighbor_avg_degree(spark, sf_dir):
    """Average degree of a user's neighbours (one entry per incident edge)."""
    return gr.neighbor_avg_degree(Lake(spark, sf_dir).edges, "user_")
