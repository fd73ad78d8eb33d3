"""DuckDB twins of the pipeline, as SQL text over the driver's tables.

Each oracle is ``WITH <base CTEs> SELECT ...``. The base chain re-derives the
raw log from ``events`` with the same fixed projection as
``tracewise.sources.fixtures``; nodes and edges come from one pass over it, and the
gold features from flags per edge that are counted with FILTER. Output column names
"""

from __future__ import annotations

from tracewise.functions.vocabulary import FEATURES
from tracewise.sources.fixtures import BATCH_START, CUTOFF, LOOKBACK_DAYS, TOP_K

SHARES = "('shared_link', 'public_share_accessed')"
FILES = "('file_accessed', 'file_written', 'file_updated', 'file_created', 'file_deleted')"
LOGINS = "('login_failed', 'login_succeeded', 'login_attempt')"
ROOT = ("CASE WHEN length(string_split(path, '/')[1]) < 1 THEN string_split(path, '/')[2] "
        "ELSE string_split(path, '/')[1] END")
STATUS = "CASE WHEN errorCode IS NULL OR errorCode = 200 THEN 'success' ELSE 'failed' END"

CTES: dict[str, str] = {}

CTES["typed"] = """
SELECT event_id AS id, user_id AS u, ts,
  CASE event_id % 12 WHEN 0 THEN 'login_attempt' WHEN 1 THEN 'login_succeeded' WHEN 2 THEN 'login_failed'
    WHEN 3 THEN 'file_accessed' WHEN 4 THEN 'file_accessed' WHEN 5 THEN 'file_written' WHEN 6 THEN 'file_updated'
    WHEN 7 THEN 'file_created' WHEN 8 THEN 'file_deleted' WHEN 9 THEN 'shared_link'
    WHEN 10 THEN 'public_share_accessed' ELSE 'session_closed' END AS type
FROM events"""

CTES["raw"] = f"""
SELECT id,
  u % 2 = 0 AS isLocalIP,
  CASE WHEN u % 5 = 0 THEN 'management' WHEN u % 5 = 1 THEN 'consulting' ELSE 'staff' END AS role,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS time,
  ts AS ts,
  type,
  'u' || u AS uid,
  CASE WHEN id % 13 = 0 THEN 'ip' ELSE 'name' END AS uidType,
  CAST(CASE WHEN id % 7 = 0 THEN 404 WHEN id % 5 = 0 THEN 200 END AS BIGINT) AS errorCode,
  CAST(CASE WHEN type IN {SHARES} THEN (id + u * 3) % 25 END AS BIGINT) AS itemSource,
  CASE WHEN type IN {SHARES} THEN (CASE WHEN (id + u * 3) % 25 < 15 THEN 'file' ELSE 'folder' END) END AS itemType,
  CAST(NULL AS VARCHAR) AS newpath,
  CAST(NULL AS VARCHAR) AS oldpath,
  CASE WHEN type IN {FILES} THEN (CASE WHEN id % 97 = 0 THEN '/' WHEN id % 89 = 0 THEN NULL
       ELSE (CASE WHEN id % 2 = 0 THEN '/' ELSE '' END) || 'dir' || ((id * 3 + u * u) % 37) || '/f' || id END) END AS path,
  CAST(NULL AS BOOLEAN) AS run,
  CASE WHEN type IN {SHARES} AND id % 17 <> 0 THEN 'u' || ((id * 7 + u) % 20) END AS token,
  CAST(NULL AS BIGINT) AS "trigger",
  CASE WHEN type = 'shared_link' THEN 'u' || u WHEN type = 'public_share_accessed' THEN 'u' || ((u + 1) % 150) END AS uidOwner,
  CAST(NULL AS VARCHAR) AS "user"
FROM typed"""

CTES["bronze"] = """
SELECT id, ts AS event_ts, role, type AS event_type, uid AS entity_id, uidType AS entity_type,
  errorCode, itemSource, itemType, newpath, oldpath, path, run, token, "trigger", uidOwner, "user"
FROM raw"""

def nodes_sql(src: str = "bronze") -> str:
    """All node candidates of an event as a list, flattened once."""
    return f"""
SELECT DISTINCT c.key AS id, c.key AS name, c.kind AS entity_type, c.role AS entity_role FROM (
  SELECT unnest([
    {{'key': 'user_' || entity_id, 'kind': 'user', 'role': role}},
    {{'key': CASE WHEN event_type IN {SHARES} THEN 'share_obj_' || itemSource END, 'kind': 'share_obj_' || itemType, 'role': NULL}},
    {{'key': CASE WHEN event_type IN {FILES} AND length(path) > 1 THEN 'root_folder_' || {ROOT} END, 'kind': 'root_folder', 'role': NULL}}
  ]) AS c FROM {src} WHERE entity_type = 'name')
WHERE c.key IS NOT NULL AND c.kind IS NOT NULL"""


CTES["nodes"] = nodes_sql()

CTES["node_table"] = """
SELECT id, name, entity_type, MAX(entity_role) AS entity_role FROM nodes GROUP BY ALL"""


def edges_sql(src: str = "bronze") -> str:
    """One pass: the rule that an event falls under decides both ends."""
    return f"""
SELECT DISTINCT id, event_ts, event_type AS relationship,
  CASE rule WHEN 'share' THEN 'user_' || uidOwner WHEN 'access' THEN 'share_obj_' || itemSource ELSE 'user_' || entity_id END AS src,
  CASE rule WHEN 'share' THEN 'share_obj_' || itemSource WHEN 'access' THEN 'user_' || token ELSE 'root_folder_' || {ROOT} END AS dst,
  CASE rule WHEN 'share' THEN 'user_' || token WHEN 'access' THEN 'user_' || uidOwner ELSE path END AS entity_sub_relationship,
  CASE WHEN rule = 'file' THEN 'local_file' ELSE itemType END AS item_type_shared,
  {STATUS} AS status
FROM (SELECT *, CASE WHEN event_type = 'shared_link' THEN 'share' WHEN event_type = 'public_share_accessed' THEN 'access'
        WHEN event_type IN {FILES} AND length(path) > 1 THEN 'file' END AS rule
      FROM {src} WHERE entity_type = 'name')
WHERE rule IS NOT NULL"""


CTES["edges"] = edges_sql()

CTES["sysf"] = f"""
SELECT dst AS id, COUNT(*)::INTEGER AS inDegree FROM edges
WHERE relationship LIKE 'file%' AND dst IS NOT NULL GROUP BY dst ORDER BY inDegree DESC, id ASC LIMIT {TOP_K}"""

CUT = f"TIMESTAMP '{CUTOFF}'"


def _per_day(counts: dict[str, str]) -> str:
    return ", ".join(f"{count} / LogDurationInDays AS {rate}" for count, rate in counts.items())


def _days(last: str) -> str:
    return f"(date_diff('day', min_ts, {last}) + 1)::INTEGER AS LogDurationInDays"


LOGIN_COUNTS = {"TotalLoginAttempts": "AvgLoginAttemptsPerDay", "TotalFailedAttempts": "AvgFailedAttemptsPerDay"}


def login_sql(events: str, last: str) -> str:
    """``events``: login events to count; ``last``: the end of a user's span, an aggregate."""
    return f"""
SELECT *, 'user_' || entity_id AS user_join_key, {_per_day(LOGIN_COUNTS)} FROM (
  SELECT entity_id, min_ts, max_ts, {_days("max_ts")}, TotalFailedAttempts, TotalLoginAttempts FROM (
    SELECT entity_id, MIN(event_ts) AS min_ts, {last} AS max_ts,
      COUNT(id) FILTER (WHERE event_type = 'login_failed') AS TotalFailedAttempts,
      COUNT(id) FILTER (WHERE event_type = 'login_attempt') AS TotalLoginAttempts
    FROM {events} WHERE entity_type = 'name' AND event_type IN {LOGINS} GROUP BY entity_id))"""


FILE_COUNTS = {n: n.replace("NormalFolder", "NormFolder") + "PerDay" if "Deleted" in n else n + "PerDay" for n in (
    "NumTimesWrittenToSysFolder", "NumTimesDeletedSysFolder", "NumTimesAccessedSysFolder",
    "NumTimesAccessedNormalFolder", "NumTimesDeletedNormalFolder")}


def files_sql(edges: str, last: str) -> str:
    """Flags per file edge, then distinct edge ids per user and flag."""
    return f"""
SELECT *, {_per_day(FILE_COUNTS)} FROM (
  SELECT id, id AS user_join_key, min_ts, max_ts, {_days("max_ts")}, {", ".join(FILE_COUNTS)} FROM (
    SELECT src AS id, MIN(event_ts) AS min_ts, {last} AS max_ts,
      COUNT(DISTINCT edge) FILTER (WHERE in_system AND wrote) AS NumTimesWrittenToSysFolder,
      COUNT(DISTINCT edge) FILTER (WHERE in_system AND deleted) AS NumTimesDeletedSysFolder,
      COUNT(DISTINCT edge) FILTER (WHERE in_system AND accessed) AS NumTimesAccessedSysFolder,
      COUNT(DISTINCT edge) FILTER (WHERE accessed AND NOT in_system) AS NumTimesAccessedNormalFolder,
      COUNT(DISTINCT edge) FILTER (WHERE deleted AND NOT in_system) AS NumTimesDeletedNormalFolder
    FROM (SELECT src, id AS edge, event_ts, coalesce(dst IN (SELECT id FROM sysf), FALSE) AS in_system,
            relationship IN ('file_written', 'file_updated') AS wrote, relationship = 'file_deleted' AS deleted,
            relationship = 'file_accessed' AS accessed
          FROM {edges} WHERE starts_with(relationship, 'file'))
    GROUP BY src))"""


SHARE_COUNTS = {n: n + "PerDay" for n in ("NumUsersSharingWith", "NumFilesShared", "NumFailedFileShares", "NumFailedShareReadAttempts")}


def sharing_sql(edges: str, accesses: str, last: str) -> str:
    """Share edges per source; answers are looked up per (share object, token) in a table of their own."""
    return f"""
SELECT *, {_per_day(SHARE_COUNTS)} FROM (
  SELECT m.id, m.id AS user_join_key, min_ts, max_ts, {_days("max_ts")},
    CASE WHEN r.answers > 0 THEN 1 ELSE 0 END AS has_reciprocal_accessed_shares,
    coalesce(r.answers, 0) AS num_reciprocal_accessed_shares,
    CASE WHEN NumFilesShared > 0 THEN 1 ELSE 0 END AS HasSharedFiles, {", ".join(SHARE_COUNTS)}
  FROM (SELECT src AS id, MIN(event_ts) AS min_ts, {last} AS max_ts,
      COUNT(DISTINCT entity_sub_relationship) FILTER (WHERE relationship = 'shared_link') AS NumUsersSharingWith,
      COUNT(DISTINCT id) FILTER (WHERE relationship = 'shared_link') AS NumFilesShared,
      COUNT(DISTINCT id) FILTER (WHERE relationship = 'shared_link' AND status <> 'success') AS NumFailedFileShares,
      COUNT(DISTINCT id) FILTER (WHERE relationship = 'public_share_accessed' AND status <> 'success') AS NumFailedShareReadAttempts
    FROM {edges} WHERE relationship IN {SHARES} GROUP BY src) m
  LEFT JOIN (SELECT owner AS id, COUNT(DISTINCT answer) AS answers FROM (
      SELECT o.src AS owner, unnest(t.ids) AS answer
      FROM (SELECT DISTINCT src, dst, entity_sub_relationship FROM {edges} WHERE relationship IN {SHARES}) o
      JOIN (SELECT src, dst, list(DISTINCT id) AS ids FROM {accesses} WHERE relationship = 'public_share_accessed' GROUP BY ALL) t
        ON t.src = o.dst AND t.dst = o.entity_sub_relationship) GROUP BY owner) r ON r.id IS NOT DISTINCT FROM m.id)"""


def frame_sql(keys: str, key: str, out: str, login: str, files: str, sharing: str) -> str:
    """The key and the model features, 0 where a user has no row."""
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURES)
    return f"""
SELECT k.{key} AS {out}, {filled} FROM {keys} AS k
LEFT JOIN {login} ON {login}.user_join_key = k.{key}
LEFT JOIN {files} ON {files}.user_join_key = k.{key}
LEFT JOIN {sharing} ON {sharing}.user_join_key = k.{key}"""


CTES["hist_events"] = f"SELECT * FROM bronze WHERE event_ts <= {CUT}"
CTES["hist_login"] = login_sql("hist_events", "MAX(event_ts)")
CTES["hist_edges"] = f"SELECT * FROM edges WHERE event_ts <= {CUT}"
CTES["hist_files"] = files_sql("hist_edges", "MAX(event_ts)")
CTES["hist_sharing"] = sharing_sql("hist_edges", "hist_edges", "MAX(event_ts)")
CTES["user_nodes"] = "SELECT id FROM node_table WHERE entity_type = 'user'"
CTES["training_frame"] = frame_sql("user_nodes", "id", "id", "hist_login", "hist_files", "hist_sharing")


def rolling_ctes(batch: str, batch_users: str, bounds: str, p: str) -> dict[str, str]:
    """Rolling features of a batch's users in the lookback before its last event; table names start with ``p``."""
    last = f"(SELECT max_ts FROM {bounds})"
    inside = f"event_ts >= (SELECT window_start FROM {bounds}) AND event_ts <= {last}"
    return {
        bounds: f"SELECT MAX(event_ts) AS max_ts, MAX(event_ts) - INTERVAL {LOOKBACK_DAYS} DAY AS window_start FROM {batch}",
        batch_users: f"SELECT DISTINCT 'user_' || entity_id AS entity_id FROM {batch} WHERE entity_type = 'name' AND entity_id IS NOT NULL",
        f"{p}events": f"SELECT * FROM bronze WHERE {inside} AND 'user_' || entity_id IN (SELECT entity_id FROM {batch_users})",
        f"{p}edges": f"SELECT * FROM edges WHERE {inside} AND src IN (SELECT entity_id FROM {batch_users})",
        f"{p}acc": f"SELECT * FROM edges WHERE {inside} AND relationship = 'public_share_accessed'",
        f"{p}login": login_sql(f"{p}events", f"ANY_VALUE({last})"),
        f"{p}files": files_sql(f"{p}edges", f"ANY_VALUE({last})"),
        f"{p}sharing": sharing_sql(f"{p}edges", f"{p}acc", f"ANY_VALUE({last})"),
        f"{p}frame": frame_sql(batch_users, "entity_id", "user_id", f"{p}login", f"{p}files", f"{p}sharing"),
    }


CTES["batch"] = f"SELECT * FROM bronze WHERE event_ts >= TIMESTAMP '{BATCH_START}'"
_ROLL = rolling_ctes("batch", "batch_users", "bounds", "r_")
CTES |= {n: q for n, q in _ROLL.items() if n in ("bounds", "batch_users", "r_events", "r_edges", "r_acc")}
CTES |= {"roll_login": _ROLL["r_login"], "roll_files": _ROLL["r_files"], "roll_sharing": _ROLL["r_sharing"],
         "rolling_frame": frame_sql("batch_users", "entity_id", "user_id", "roll_login", "roll_files", "roll_sharing")}
# the same for a feed that arrives as one batch
CTES |= rolling_ctes("bronze", "feed_users", "feed_bounds", "feed_")

# API log lines as parsed fields
CTES["api_logs"] = """
SELECT '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
  '02:00:00:00:00:' || lower(lpad(printf('%X', user_id % 256), 2, '0')) AS mac,
  'u' || user_id AS user_id,
  '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') AS timestamp_raw,
  '+0000' AS timezone,
  'GET /api/' || event_type || ' HTTP/1.1' AS api_call,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS code,
  ts AS _ts
FROM events"""


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None,
              recursive: bool = False) -> str:
    """``WITH`` the named base CTEs (in dependency order), then ``extra`` CTEs, then ``body``."""
    order = list(CTES)
    needed = _closure(names)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in order if n in needed]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


_DEPS = {
    "typed": [], "raw": ["typed"], "bronze": ["raw"], "nodes": ["bronze"], "node_table": ["nodes"],
    "edges": ["bronze"], "sysf": ["edges"], "hist_events": ["bronze"], "hist_login": ["hist_events"], "hist_edges": ["edges"],
    "hist_files": ["hist_edges", "sysf"], "hist_sharing": ["hist_edges"], "user_nodes": ["node_table"],
    "training_frame": ["user_nodes", "hist_login", "hist_files", "hist_sharing"],
    "batch": ["bronze"], "bounds": ["batch"], "batch_users": ["batch"],
    "r_events": ["bronze", "bounds", "batch_users"], "r_edges": ["edges", "bounds", "batch_users"], "r_acc": ["edges", "bounds"],
    "roll_login": ["r_events"], "roll_files": ["r_edges", "sysf"], "roll_sharing": ["r_edges", "r_acc"],
    "rolling_frame": ["batch_users", "roll_login", "roll_files", "roll_sharing"],
    "feed_bounds": ["bronze"], "feed_users": ["bronze"], "feed_events": ["bronze", "feed_bounds", "feed_users"],
    "feed_edges": ["edges", "feed_bounds", "feed_users"], "feed_acc": ["edges", "feed_bounds"], "feed_login": ["feed_events"],
    "feed_files": ["feed_edges", "sysf"], "feed_sharing": ["feed_edges", "feed_acc"],
    "feed_frame": ["feed_users", "feed_login", "feed_files", "feed_sharing"],
    "api_logs": [],
}


def _closure(names) -> set[str]:
    out: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in out:
            out.add(n)
            stack.extend(_DEPS.get(n, []))
    return out
