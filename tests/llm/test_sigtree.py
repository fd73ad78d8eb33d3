"""Exact Jaccard components against all pairs; pruning and signatures never lose a link."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm import edge_rows
from tracewise.llm import sigtree


def sets_of(texts, size):
    out = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute(rows, size, num, den):
    sets, up = sets_of([t for _, t in rows], size), list(range(len(rows)))

    def root(i):
        return i if up[i] == i else root(up[i])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((str(d), len(sets[i]), str(min(ids) if ids and sets[i] else d)))
    return sorted(out)


def near_copies(seed, n):
    r, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(40)]
    while len(out) < n:
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 5, 9, 12, 30, 80, 200]))]
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            if r.random() < 0.3:
                copy = copy[:-1] or copy
            out.append(" ".join(copy).upper() if r.random() < 0.2 else "\t".join(copy))
    return out[:n]


@pytest.mark.parametrize(("size", "num", "tile_sets"), [(3, 90, 2000), (5, 80, 2000), (3, 60, 7), (2, 80, 3)])
def test_components_equal_all_pairs(spark, size, num, tile_sets):
    rows = [(1000 - i, t) for i, t in enumerate(near_copies(size * num, 260))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sigtree.jaccard_components(df, size, num, 100, tile_sets=tile_sets).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, size, num, 100)


def test_awkward_rows(spark):
    docs = edge_rows.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sigtree.jaccard_components(docs, 3, 90).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, 3, 90, 100)
    assert sigtree.jaccard_components(edge_rows.no_documents(spark)).count() == 0
    kept = [r["doc_id"] for r in sigtree.keep_one_per_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 6, 8, 9, None, 10, 11], key=str)


def test_linked_sets_share_a_signature_however_many_they_spare():
    r = np.random.default_rng(2)
    for num in (60, 80, 90, 95):
        t = sigtree.Threshold(num, 100)
        for _ in range(400):
            n = int(r.choice([1, 2, 3, 4, 6, 8, 11, 20, 40, 90, 300]))
            base = np.unique(r.integers(0, 2 ** 63, n).astype(np.uint64))
            drop = int(r.integers(0, n // 4 + 1))
            other = np.unique(np.concatenate([base[drop:], r.integers(0, 2 ** 63, int(r.integers(0, n // 4 + 1))).astype(np.uint64)]))
            if len(other) and sigtree.linked(base, other, t):
                sent = []
                for x in (base, other):
                    found = t.signatures(x)
                    sent.append((np.concatenate([s for s, _ in found]), found))
                shared = np.intersect1d(sent[0][0], sent[1][0])
                assert shared.size
                # leave out as many shared ones as both can spare: one is still shared
                for _, found in sent:
                    for s, spare in found:
                        mine = np.intersect1d(s, shared)
                        if spare >= 0 and mine.size:
                            assert mine.size > min(spare, mine.size - 1)


def test_common_passages_do_not_chain_and_needed_ones_do(spark):
    """Strangers that hold one long common passage: exact links, though the passage's signatures are common."""
    r = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(120):
        own = " ".join(f"x{r.randrange(10 ** 6)}" for _ in range(r.choice([4, 6, 30, 90])))
        rows.append((i, f"{own} {passage}"))
        if i % 9 == 0:
            rows.append((1000 + i, f"{own} {passage} tail"))
    rows += [(2000 + i, passage + f" y{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sigtree.jaccard_components(df, 5, 80, 100).collect()
    assert sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in got) == brute(rows, 5, 80, 100)


def test_tree_keeps_every_linked_pair():
    r = np.random.default_rng(7)
    t = sigtree.Threshold(80, 100)
    sets = []
    for _ in range(60):
        base = r.integers(0, 2 ** 63, int(r.integers(5, 120))).astype(np.uint64)
        sets += [np.unique(base[r.random(len(base)) < 0.95]) for _ in range(3)]
    sets = [s for s in sets if len(s)]
    found = {(int(a), int(b)) for x, y in sigtree.SignatureTree(sets).pairs(t) for a, b in zip(x, y, strict=True)}
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if sigtree.linked(sets[i], sets[j], t)}
    assert linked <= found and len(found) < len(sets) ** 2 / 8


def test_threshold_counts():
    t = sigtree.Threshold(90, 100)
    for a in range(1, 60):
        for b in range(a, 60):
            for common in range(a + 1):
                assert (common >= t.needed(a, b)) == (100 * common >= 90 * (a + b - common))


def test_only_sets_apart_meet_their_block_again(spark):
    """One outlier per tile: a few slots against the tiles, not all tile pairs, and every pair of unlike labels meets."""
    rows = [(100 * tile + k, 7, tile, 1 if k else 2 + tile, 10) for tile in range(1, 41) for k in range(8)]
    others = sigtree.sets_apart(spark.createDataFrame(rows, "h1 long, block long, tile long, label long, n long"), 10 ** 6, 8).persist()
    assert others.where("slot is not null").count() == 40 and others.first()["slots"] == 5
    met, pairs = set(), {}
    for r in sigtree.slot_pairs(others, 100).collect():
        pairs.setdefault((r["i"], r["j"]), set()).add((r["h1"], r["label"]))
    for found in pairs.values():
        met |= {(a, b) for a, la in found for b, lb in found if la != lb}
    assert len(pairs) == 5 * 40 and max(map(len, pairs.values())) < 40
    assert met == {(a[0], b[0]) for a in rows for b in rows if a[3] != b[3]}
    assert {r["i"] for r in sigtree.slot_pairs(others, 2).select("i").distinct().collect()} == {0, 1}


def test_outliers_of_split_blocks_in_rounds(spark, monkeypatch):
    """Small tiles and several rounds: outliers that share passages with a big group link as brute force says."""
    monkeypatch.setattr(sigtree, "FIRST_SLOTS", 1)
    r = random.Random(5)
    core = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(core)
        words[r.randrange(60)] = f"v{i}"
        if i % 3 == 0:                       # every third is far from the core, and near its neighbours
            words = core[:30] + [f"o{i // 18}_{k}" for k in range(30)]
            words[r.randrange(30, 60)] = f"w{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names, real = [], sigtree.materialize
    monkeypatch.setattr(sigtree, "materialize", lambda d, name: (names.append(name), real(d, name))[1])
    got = sigtree.jaccard_components(df, 2, 60, 100, tile_sets=3).collect()
    assert sorted((str(x["doc_id"]), x["n_shingles"], str(x["component_id"])) for x in got) == brute(rows, 2, 60, 100)
    assert names.count("more-links") >= 2


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    base, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in ("stone", "river", "cloud"))
    near = base.replace("stone59", "gravel")
    rows = [(1, base), (5, base), (5, other), (7, third), (7, " ".join(reversed(third.split()))), (8, near), (9, other.upper()), (9, other.upper()),
            (10, ""), (10, ""), (10, None), (None, base), (None, base), (11, third), (11, third + " end")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, _set1 int, h1 int")
    kept = sigtree.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, base), (5, other), (7, third), (7, rows[4][1]), (10, ""), (10, None), (None, base), (None, base)], key=str)


def test_many_marked_ids_are_not_broadcast(spark):
    n = 60_000
    texts = spark.range(n).selectExpr("id", "concat_ws(' ', transform(sequence(1, 6), i -> concat('w', id, '-', i))) as text")
    rows = texts.selectExpr("id as doc_id", "text", "1 as `a.b`").unionByName(texts.selectExpr("id + 100000", "text", "2").toDF("doc_id", "text", "a.b"))
    odd = spark.createDataFrame([(None, "w7-1 w7-2 w7-3 w7-4 w7-5 w7-6", 3), (200_000, "quite alone", 4), (200_001, None, 5), (200_002, "", 6)], "doc_id long, text string, `a.b` int")
    kept = sigtree.keep_one_per_group(rows.unionByName(odd))
    assert kept.columns == rows.columns
    assert sorted(kept.selectExpr("doc_id", "`a.b`").collect(), key=str) == sorted([*((i, 1) for i in range(n)), (None, 3), (200_000, 4), (200_001, 5), (200_002, 6)], key=str)
    kept.collect()
    joins = [x for x in kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "Join" in x]
    assert any("ShuffledHashJoin" in x and "LeftAnti" in x for x in joins)
    assert not any("BroadcastHashJoin" in x and "LeftAnti" in x for x in joins)


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("filter_bits", [2 ** 15, 2 ** 25])
def test_ids_met_by_filter_and_by_broadcast_are_the_same(spark, monkeypatch, how, filter_bits):
    rows = spark.createDataFrame([(i if i % 500 else None, f"t{i}", i, "x") for i in range(4000)], "doc_id int, text string, _place int, _mask string")
    ids = spark.createDataFrame([(i * 3, i) for i in range(2000)] + [(None, -1), (6, -2)], "rep long, other long")
    monkeypatch.setattr(sigtree, "FILTER_BITS", filter_bits)
    got = []
    for limit in (0, 2 ** 25):
        monkeypatch.setattr(sigtree, "BROADCAST_BYTES", limit)
        found = sigtree.met_by_id(rows, ids, "rep", how)
        assert found.columns == rows.columns + (["other"] if how == "inner" else [])
        got.append(sorted(map(tuple, found.collect()), key=str))
    held = {i * 3 for i in range(2000)} | {None}
    assert got[0] == got[1]
    assert {r[1] for r in got[0]} == {f"t{i}" for i in range(4000) if ((i if i % 500 else None) in held) == (how != "left_anti")}
