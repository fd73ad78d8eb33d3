"""Periodic runs against a search of every period at every place."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tests.llm.edge_rows import documents, no_documents
from tracewise.llm import periodic, queries


def brute_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q) and i > start:
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(r):
    words = [str(r.randrange(r.choice([1, 2, 3, 5, 30]))).encode() for _ in range(r.randint(0, 150))]
    for _ in range(r.randint(0, 3)):
        if len(words) > 5:
            a = r.randrange(len(words))
            p = r.randint(1, max(1, (len(words) - a) // 2))
            for i in range(a, a + r.randint(0, len(words) - a)):
                words[i] = words[a + (i - a) % p]
    return words


def fibonacci(n):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    for _ in range(40):
        texts = [some_text(r) for _ in range(r.randint(1, 8))] + [fibonacci(r.randint(1, 200)), [b"x"] * r.randint(0, 60)]
        n, runs, collapsed = periodic.search([b" \t".join(t) for t in texts])
        assert n == [len(t) for t in texts]
        for words, got, rest in zip(texts, runs, collapsed, strict=True):
            want = brute_runs(words)
            assert [(g["start"], g["length"], g["period"]) for g in got] == want
            assert rest == brute_collapse(words, want)


def test_long_periods_and_one_repeated_word():
    r = random.Random(9)
    part = [str(r.randrange(10 ** 6)).encode() for _ in range(3001)]
    _, runs, _ = periodic.search([b" ".join(part * 3 + [b"end"]), b"a " * 30_000])
    assert runs == [[{"start": 0, "length": 9003, "period": 3001}], [{"start": 0, "length": 30_000, "period": 1}]]


def test_blocks_are_bounded(monkeypatch):
    text = b" ".join(fibonacci(900))
    whole = periodic.search([text])
    monkeypatch.setattr(periodic, "PAIRS", 64)
    assert periodic.search([text]) == whole


def test_awkward_rows(spark):
    docs = documents(spark, "la " * 40)
    rows = periodic.periodic_runs(docs).collect()
    assert len(rows) == docs.count()
    want = sorted(brute_collapse(w, brute_runs(w)).decode() for w in ((t or "").encode().split() for (t,) in docs.select("text").collect()))
    assert sorted(r["collapsed"] for r in rows) == want
    assert any(r["runs"] for r in rows) and all(r["runs"] == [] for r in rows if not r["n_words"])
    assert periodic.periodic_runs(no_documents(spark)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, least=4)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r.asDict() for r in queries.op13_periodic_runs(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    planted = 0
    for doc_id, text in texts:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        if n > 1500:
            continue                       # brute force is quadratic
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": None if not runs else 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(brute_collapse(words, runs)).hexdigest()}
    assert planted
