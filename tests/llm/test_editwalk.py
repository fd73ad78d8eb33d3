"""Fingerprints: the walk against a step-by-step version, the edited texts, and what likeness tells apart."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm import edge_rows
from tracewise.llm import editwalk


def slow_walk(codes, begin):
    table, s, out = editwalk.stays(), begin, []
    for c in codes.tolist():
        s += int(table[c + (s & (editwalk.PERIOD - 1))])
        out.append(s)
    return out


def test_walk_equals_the_step_by_step_version():
    texts = [edge_rows.prose(i, i % 37 * 5) for i in range(150)] + ["", "x" * 5000]
    codes = [editwalk.classes(t) for t in texts]
    begin = [i % 11 for i in range(len(texts))]
    for got, c, b in zip(editwalk.walk(codes, begin), codes, begin, strict=True):
        assert got.tolist() == slow_walk(c, b)


def test_likeness_follows_edits():
    def prints(texts):
        codes = [editwalk.classes(t) for t in texts]
        return list(map(editwalk.fingerprint, codes, editwalk.walk(codes, [0] * len(codes))))
    r = random.Random(1)
    near, far = [], []
    for i in range(60):
        a = edge_rows.prose(i, 150 + 20 * i)
        b = list(a)
        for _ in range(3):
            at = r.randrange(len(b))
            b[at:at + 1] = r.choice([[], [b[at], "q"], ["z"]])
        x, y, z = prints([a, "".join(b), edge_rows.prose(1000 + i, 150 + 20 * i)])
        near.append(editwalk.likeness(x, y))
        far.append(editwalk.likeness(x, z))
        assert editwalk.likeness(x, x) == 1.0
    assert np.mean(near) > 0.75 and np.mean(far) < 0.25 and min(near) > np.mean(far)
    assert editwalk.likeness("0:", "0:") == 1.0 and editwalk.likeness("0:", prints(["abc def"])[0]) == 0.0


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_edits_and_next_documents(spark, block_rows):
    docs = edge_rows.documents(spark)
    rows = sorted(((d["doc_id"], d["text"] or "") for d in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = editwalk.compare_with_edits(docs, block_rows=block_rows).collect()
    want = sorted((str(i), len(t), hashlib.sha256(editwalk.edited_text(t, rows[(n + 1) % len(rows)][1]).encode()).hexdigest())
                  for n, (i, t) in enumerate(rows))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fingerprint"] == by_id[7]["fingerprint"]
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == "0:" and by_id[3]["near_next"] == 1.0
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert by_id[8]["near_edited"] > 0.6 and by_id[2]["near_edited"] > 0.5
    assert editwalk.compare_with_edits(edge_rows.no_documents(spark)).count() == 0
    alone = editwalk.compare_with_edits(docs.where("doc_id = 2")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_edited_fingerprint_is_that_of_the_edited_text(spark):
    df = spark.createDataFrame([(i, edge_rows.prose(i, 40 * i)) for i in range(12)], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in editwalk.compare_with_edits(df, block_rows=3).collect():
        c = editwalk.classes(editwalk.edited_text(rows[r["doc_id"]], rows[(r["doc_id"] + 1) % 12]))
        assert r["edited_fingerprint"] == editwalk.fingerprint(c, editwalk.walk([c], [0])[0])


def prints_of(texts):
    codes = [editwalk.classes(t) for t in texts]
    return list(map(editwalk.fingerprint, codes, editwalk.walk(codes, [0] * len(codes))))


def components(n, pairs):
    up = list(range(n))
    for a, b in pairs:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    out = []
    for i in range(n):
        while up[i] != i:
            i = up[i]
        out.append(i)
    return out


def edited(text, r, where, n):
    """``n`` edits of one character in the first, middle or last third, or anywhere."""
    b = list(text)
    third = len(b) // 3
    lo, hi = {"start": (0, third), "middle": (third, 2 * third), "end": (2 * third, len(b)), "any": (0, len(b))}[where]
    for _ in range(n):
        at = r.randrange(lo, min(hi, len(b)))
        b[at:at + 1] = r.choice([[], [b[at], "q"], ["z"]])
    return "".join(b)


@pytest.mark.parametrize("where", ["start", "middle", "end", "any"])
def test_bands_find_pairs_wherever_the_edits_are(where):
    """At least 0.9 of the pairs at 0.8 or more share a band, short and long texts and both sides of a level's edge alike."""
    r = random.Random(where)
    pairs = hit = 0
    for i in range(400):
        a = edge_rows.prose(i, r.choice([2, 4, 8, 20, 60, 150, 400]))
        f, g = prints_of([a, edited(a, r, where, r.randint(1, 3))])
        if editwalk.likeness(f, g) >= editwalk.LIKE:
            pairs += 1
            hit += bool(set(editwalk.bands_of(f)) & set(editwalk.bands_of(g)))
    assert pairs >= 80 and hit >= 0.9 * pairs, (pairs, hit)


def test_linked_joins_what_all_pairs_join():
    r = random.Random(4)
    texts = [edge_rows.prose(i // 4, 3 + i // 4 * 7) for i in range(120)]
    texts = [edited(t, r, "any", r.randint(0, 3)) for t in texts] + ["", ""]
    prints = prints_of(texts)
    every = [(i, j) for i in range(len(prints)) for j in range(len(prints)) if i < j and prints[i] != prints[j]
             and editwalk.likeness(prints[i], prints[j]) >= editwalk.LIKE]
    found = editwalk.linked(prints, prints)
    assert components(len(prints), found) == components(
        len(prints), every + [(i, j) for i in range(len(prints)) for j in range(i) if prints[i] == prints[j] != "0:"])


def test_links_of_planted_copies(spark, monkeypatch):
    """Components against brute force over all pairs, with tiles of a few rows so that bands are cut."""
    monkeypatch.setattr(editwalk, "TILE", 3)
    r = random.Random(9)
    base = {i: edge_rows.prose(i, 40 + 8 * i) for i in range(30)}
    rows = list(base.items())
    for k, where in enumerate(("start", "middle", "end")):
        rows += [(100 * (k + 1) + i, edited(t, r, where, 2)) for i, t in base.items()]
    rows += [(1000 + i, edited(base[5], r, "any", 1 + i % 9)) for i in range(40)] + [(7, base[8]), (7, base[9]), (None, base[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    prints = prints_of([t for _, t in rows])
    every = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if editwalk.likeness(prints[i], prints[j]) >= editwalk.LIKE]
    groups = components(len(rows), every)
    smallest = {g: min((rows[i][0] for i in range(len(rows)) if groups[i] == g and rows[i][0] is not None)) for g in groups}
    want = sorted((str(i), prints.count(p), smallest[g]) for (i, _), p, g in zip(rows, prints, groups, strict=True))
    got = sorted((str(x["doc_id"]), x["n_copies"], x["component_id"]) for x in editwalk.link_documents(df).collect())
    assert len(got) == len(want)
    same = sum(a == b for a, b in zip(got, want, strict=True))
    assert same >= 0.97 * len(want), [p for p in zip(got, want, strict=True) if p[0] != p[1]]


def test_links_of_awkward_rows(spark):
    docs = edge_rows.documents(spark)
    got = sorted((str(x["doc_id"]), x["n_copies"], x["n_links"], str(x["component_id"])) for x in editwalk.link_documents(docs).collect())
    assert [g for g in got if g[0] in ("1", "7")] == [("1", 2, 0, "1"), ("7", 2, 0, "1")]
    assert [g for g in got if g[0] in ("3", "4")] == [("3", 2, 0, "3"), ("4", 2, 0, "3")]
    assert [g for g in got if g[0] == "10"] == [("10", 2, 0, "10")] * 2 and ("None", 1, 0, "None") in got
    assert editwalk.link_documents(edge_rows.no_documents(spark)).count() == 0
