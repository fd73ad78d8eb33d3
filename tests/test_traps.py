"""Hand-made rows for the data-dependent traps (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tracewise.functions.scalar import root_segment, status_of
from tracewise.operators import features as feat
from tracewise.operators.bronze import to_bronze
from tracewise.operators.graph import degrees, graph_vertices, in_degrees
from tracewise.operators.silver import active_batch_users, silver_edges, silver_nodes
from tracewise.operators.upsert import EVENT_KEYS, NODE_KEYS, NODE_ORDER, latest_per_key, upsert
from tracewise.sources.json_logs import RAW_LOG_SCHEMA
from tracewise.sources.text_logs import clean_api_logs, parse_api_log_lines, split_outside_quotes

PARAM_FIELDS = [f.name for f in RAW_LOG_SCHEMA["params"].dataType.fields]


def raw(spark, rows):
    """rows: dicts with id, time, type, uid, optional role/uidType and params keys."""
    out = []
    for r in rows:
        params = {k: r.get(k) for k in PARAM_FIELDS}
        out.append((r["id"], None, params, r.get("role", "staff"), r.get("time"), r["type"], r.get("uid"),
                    r.get("uidType", "name")))
    return spark.createDataFrame(out, RAW_LOG_SCHEMA)


def test_t1_bad_timestamp_is_null_not_error(spark):
    b = to_bronze(raw(spark, [{"id": 1, "time": "nope", "type": "login_attempt", "uid": "a"},
                              {"id": 2, "time": None, "type": "login_attempt", "uid": "a"},
                              {"id": 3, "time": "2024-01-02T03:04:05.000001", "type": "login_attempt", "uid": "a"}]))
    got = {r["id"]: r["event_ts"] for r in b.collect()}
    assert got[1] is None and got[2] is None
    assert got[3] == dt.datetime(2024, 1, 2, 3, 4, 5, 1)


def test_t1_t2_bad_status_and_quotes(spark):
    lines = spark.createDataFrame([('1.1.1.1 m u [01/Jan/2024:00:00:01 +0000] "GET /a b" xx 7',)], "value string")
    clean = clean_api_logs(parse_api_log_lines(lines)).first()
    assert clean["status"] is None and clean["code"] == 7 and clean["timezone"] == "+0000"
    assert clean["api_call"] == "GET /a b"
    split = split_outside_quotes(lines).first()
    assert split["api_call"] == '"GET /a b"' and split["status"] is None


def test_paths_and_status(spark):
    df = spark.createDataFrame([("/a/b",), ("a/b",), ("//x",), ("abc",), ("/",), (None,)], "p string")
    got = [r[0] for r in df.select(root_segment(F.col("p"))).collect()]
    assert got == ["a", "a", "", "abc", "", None]
    codes = spark.createDataFrame([(None,), (200,), (404,)], "c bigint")
    assert [r[0] for r in codes.select(status_of(F.col("c"))).collect()] == ["success", "success", "failed"]


def test_file_edge_rules_skip_short_paths(spark):
    rows = [{"id": i, "time": "2024-01-01T00:00:00", "type": "file_written", "uid": "u1", "path": p}
            for i, p in enumerate(["/", None, "/d/f", "d/f", "//x"])]
    e = silver_edges(to_bronze(raw(spark, rows))).orderBy("id").collect()
    assert [r["dst"] for r in e] == ["root_folder_d", "root_folder_d", "root_folder_"]


def test_t9_two_roles_one_node(spark):
    rows = [{"id": 1, "time": "2024-01-01T00:00:00", "type": "login_attempt", "uid": "u1", "role": "staff"},
            {"id": 2, "time": "2024-01-01T00:00:01", "type": "login_attempt", "uid": "u1", "role": "management"}]
    nodes = silver_nodes(to_bronze(raw(spark, rows)))
    assert nodes.count() == 2
    one = latest_per_key(nodes, NODE_KEYS, NODE_ORDER).collect()
    assert len(one) == 1 and one[0]["entity_role"] == "staff"


def test_t8_event_upsert_keys_and_idempotence(spark):
    rows = [{"id": 1, "time": "2024-01-01T00:00:00", "type": "login_attempt", "uid": "u1"},
            {"id": 2, "time": "2024-01-01T00:00:00", "type": "login_failed", "uid": "u1"},
            {"id": 3, "time": "2024-01-01T00:00:00", "type": "login_failed", "uid": None}]
    b = to_bronze(raw(spark, rows))
    empty = b.limit(0)
    once = upsert(empty, b, EVENT_KEYS)
    twice = upsert(once, b, EVENT_KEYS)
    assert once.count() == 3 and twice.count() == 3
    assert sorted(r["id"] for r in twice.collect()) == [1, 2, 3]


def test_t16_t17_null_token_and_two_item_types(spark):
    rows = [{"id": 1, "time": "2024-01-01T00:00:00", "type": "public_share_accessed", "uid": "u1",
             "itemSource": 5, "itemType": "file", "uidOwner": "u2", "token": None},
            {"id": 2, "time": "2024-01-01T00:00:00", "type": "shared_link", "uid": "u2",
             "itemSource": 5, "itemType": "folder", "uidOwner": "u2", "token": "u9"}]
    b = to_bronze(raw(spark, rows))
    e = silver_edges(b)
    access = e.filter(F.col("id") == 1).first()
    assert access["dst"] is None
    assert in_degrees(e).filter(F.col("id").isNull()).count() == 0
    deg = {r["id"]: r["degree"] for r in degrees(e).collect()}
    assert deg["share_obj_5"] == 2 and None not in deg
    nodes = silver_nodes(b)
    assert nodes.filter(F.col("id") == "share_obj_5").count() == 2
    assert graph_vertices(nodes).filter(F.col("id") == "share_obj_5").count() == 1


def test_t11_top_k_tie_break(spark):
    rows = []
    i = 0
    for f in range(11):
        for _ in range(2 if f < 9 else 1):
            rows.append({"id": i, "time": "2024-01-01T00:00:00", "type": "file_written", "uid": "u1",
                         "path": f"dir{f:02d}/x"})
            i += 1
    top = feat.top_in_degree(silver_edges(to_bronze(raw(spark, rows))), k=10).collect()
    assert [r["id"] for r in top][-1] == "root_folder_dir09"
    assert [r["inDegree"] for r in top] == [2] * 9 + [1]


def _login(i, t, uid="u1", typ="login_attempt", uid_type="name"):
    return {"id": i, "time": t, "type": typ, "uid": uid, "uidType": uid_type}


def test_t15_t7_cutoff_and_batch_bounds(spark):
    rows = [_login(1, "2024-01-23T00:00:00"), _login(2, "2024-01-23T00:00:00.000001"),
            _login(3, "2024-01-24T00:00:00", uid="10.0.0.1", uid_type="ip")]
    b = to_bronze(raw(spark, rows))
    hist = feat.login_features(b, cutoff="2024-01-23 00:00:00").first()
    assert hist["TotalLoginAttempts"] == 1
    users = [r[0] for r in active_batch_users(b, "2024-01-23 00:00:00").collect()]
    assert users == ["user_u1"]


def test_t6_rolling_logins_match_prefixed_users(spark):
    rows = [_login(1, "2024-01-20T00:00:00"), _login(2, "2024-01-23T10:00:00", typ="login_failed"),
            _login(3, "2024-01-24T00:00:00")]
    b = to_bronze(raw(spark, rows))
    w = feat.rolling_window(b, "2024-01-23 00:00:00", 7)
    r = feat.login_features(b, window=w).first()
    assert r["user_join_key"] == "user_u1"
    assert r["AvgLoginAttemptsPerDay"] > 0 and r["AvgFailedAttemptsPerDay"] > 0
    assert r["LogDurationInDays"] == 5


def test_t21_rolling_reciprocal_share(spark):
    rows = [{"id": 1, "time": "2024-01-23T01:00:00", "type": "shared_link", "uid": "u1",
             "itemSource": 7, "itemType": "file", "uidOwner": "u1", "token": "u2"},
            {"id": 2, "time": "2024-01-23T02:00:00", "type": "public_share_accessed", "uid": "u2",
             "itemSource": 7, "itemType": "file", "uidOwner": "u1", "token": "u2"}]
    b = to_bronze(raw(spark, rows))
    w = feat.rolling_window(b, "2024-01-23 00:00:00", 7)
    s = feat.sharing_features(silver_edges(b), window=w).filter(F.col("id") == "user_u1").first()
    assert s["num_reciprocal_accessed_shares"] == 1 and s["HasSharedFiles"] == 1
