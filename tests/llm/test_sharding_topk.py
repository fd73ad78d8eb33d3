"""Rendezvous sharding and exact top-k against brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

from tests.llm import edge_rows
from tracewise.llm import rendezvous, topk


def test_documents_get_gapless_slots_and_move_only_into_the_new_shard(spark):
    docs = edge_rows.documents(spark)
    rows = rendezvous.shard_documents(docs, 4).collect()
    assert len(rows) == docs.count()
    want = sorted((str(d["doc_id"]), len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode())) for d in docs.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {r["doc_id"]: r["shard"] for r in rendezvous.shard_documents(docs, 5).collect()}
    assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)
    assert rendezvous.shard_documents(edge_rows.no_documents(spark)).count() == 0


def test_hot_row_is_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(rendezvous, "RUN", 7)
    df = spark.createDataFrame([(1, "same")] * 100 + [(i, "x") for i in range(2, 40)], "doc_id long, text string")
    slots = defaultdict(list)
    for r in rendezvous.shard_documents(df, 3).collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == 138
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_share_out_in_proportion(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    got = {r["shard"]: r["count"] for r in rendezvous.assign(df, "doc_id", [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(got[1] / 20000 - 0.75) < 0.02


def brute(rows, k, mod):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, qv in ok:
        if q % mod:
            continue
        qi = [math.floor(64 * x) for x in qv]
        scored = sorted((-sum(a * math.floor(64 * x) for a, x in zip(qi, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.25, r.uniform(-1, 1)]) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[3], rows[3]]
    rows += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6),
             (None, [1.0] * 6), (420, [0.5, 0.5]), (421, [0.25, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, tile string")
    as_stored = [(x["vec_id"], x["embedding"]) for x in df.collect()]
    got = topk.top_k(df, k=7, query_mod=20, query_tile=5, base_tile=16, fan_in=3)
    assert sorted(tuple(x) for x in got.collect()) == brute(as_stored, 7, 20)
    few = df.where("vec_id <= 3 or vec_id = 20")
    assert sorted(tuple(x) for x in topk.top_k(few).collect()) == brute([(i, v) for i, v in as_stored if i is not None and (i <= 3 or i == 20)], 20, 20)
    assert topk.top_k(df.limit(0)).count() == 0


def test_scores_beyond_a_long_are_held_at_its_bound(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e5, 1.0]), (2, [1e5, 2.0]), (20, [5e9, 1e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in topk.top_k(df, k=2).collect())[:2] == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, 2 ** 63 - 1)]
