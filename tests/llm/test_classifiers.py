"""Toxicity grammar and co-trained quality: machine against its parts, held-out accuracy, awkward rows."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from tests.llm import edge_rows
from tracewise.llm import cotrain, learning, toxicity

SF = "/root/testdata/sf0.1"


def test_composed_machine_equals_reading_the_whole_clause():
    """All five transducers against a plain look at the words around every insult and threat."""
    rng = np.random.default_rng(5)
    ahead, arcs = toxicity.whole_machine()
    for _ in range(400):
        roles = [toxicity.ROLES[i] for i in rng.integers(0, len(toxicity.ROLES), int(rng.integers(1, 30)))]
        state, marks = 0, []
        for role in reversed(roles):
            state, mark = ahead[state, role]
            marks.append(mark)
        state, got = 0, []
        for role, mark in zip(roles, reversed(marks), strict=True):
            state, pattern = arcs[state, role, mark]
            got.append(pattern)

        def near(i, role, reach):
            return role in roles[max(0, i - reach):i]
        for i, role in enumerate(roles):
            if role not in (toxicity.INSULT, toxicity.THREAT):
                assert got[i] is None
                continue
            behind = toxicity.TARGET in roles[i + 1:i + 5]
            flags = {f for f, on in (("reported", near(i, toxicity.REPORT, 8)), ("negated", near(i, toxicity.NEGATION, 3)),
                                     ("targeted", behind or role == toxicity.INSULT and near(i, toxicity.TARGET, 4))) if on}
            assert toxicity.PATTERNS[got[i]] == (role, frozenset(flags))


def test_inflected_threats_elision_and_typographic_apostrophes():
    s = toxicity.Scanner({"idiot": 5.0, "idiots": 5.0})

    def hit(text):
        return [toxicity.PATTERNS[i] for i in np.flatnonzero(s.features(text))]
    targeted = frozenset({"targeted"})
    for text in ("he kills you", "I am killing you", "I killed you", "they stabbed him", "ich töte dich", "er schlägt euch", "je frappe toi", "nous brûlons eux",
                 "golpearé a ellos"):
        assert hit(text) == [("threat", targeted)], text
    assert hit("l'idiot") == hit("L’idiot") == hit("trop d'idiots") == [("insult", frozenset())]
    assert hit("I don’t hurt you") == hit("I don't hurt you") == [("threat", targeted | {"negated"})]
    assert toxicity.words_of("Qu’il d'accord don't it's") == ["il", "accord", "don't", "it's"]



def test_clauses_and_patterns():
    s = toxicity.Scanner({"idiot": 5.0, "worth*": 4.0})
    assert s.clauses("a fine day. you idiot; no more\nidiotic") == [" you idiot", "idiotic"]
    names = {p: i for i, p in enumerate(toxicity.PATTERNS)}

    def hit(text):
        return [toxicity.PATTERNS[i] for i in np.flatnonzero(s.features(text))]
    assert hit("You are an idiot!") == [("insult", frozenset({"targeted"}))]
    assert hit("He said that the big idiot went") == [("insult", frozenset({"reported"}))]
    assert hit("this is not an idiot") == [("insult", frozenset({"negated"}))]
    assert hit("I will kill it") == [("threat", frozenset())] and hit("worthy thing") == [("insult", frozenset())]
    assert hit("nice") == hit("") == hit(None) == [] and len(names) == 16
    assert s.features("idiot. " * 3)[0] > s.features("idiot.")[0]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(scored, labels, label):
    rows = scored.where("held_out").join(labels.where(f"{label} is not null"), "doc_id").select("score", label).collect()
    return np.array([r["score"] for r in rows]), np.array([r[label] for r in rows])


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_held_out(tables):
    docs, labels = tables
    s, y = held_out(toxicity.score(docs, labels), labels, "toxic")
    assert auc(s, y) > 0.9 and np.mean((s >= 0.7) == (y == 1)) > 0.95


def test_quality_held_out_and_both_views(tables):
    docs, labels = tables
    scored = cotrain.score(docs, labels)
    s, y = held_out(scored, labels, "quality")
    assert auc(s, y) > 0.97 and np.mean(s[y == 1] >= cotrain.THRESHOLD) > 0.98 and np.mean(s[y == 0] < cotrain.THRESHOLD) > 0.85
    for view, least in (("text_score", 0.95), ("page_score", 0.6)):
        t, z = held_out(scored.drop("score").withColumnRenamed(view, "score"), labels, "quality")
        assert auc(t, z) > least


def test_cotraining_uses_the_other_view():
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 3000).astype(float)
    views = [np.stack([y * 2 + r.normal(0, 0.7, 3000), *r.normal(0, 1, (6, 3000))], axis=1) for _ in range(2)]
    few = cotrain.CoTrained(rounds=6).fit([v[:16] for v in views], y[:16], [v[16:2000] for v in views], [v[2000:2300] for v in views], y[2000:2300])
    alone = learning.Logistic().fit(views[0][:16], y[:16])
    test = slice(2300, 3000)
    acc = np.mean((few.scores(*[v[test] for v in views])[:, 2] > 0.5) == (y[test] == 1))
    assert acc > np.mean((alone.logit(views[0][test]) > 0) == (y[test] == 1)) and acc > 0.9


def test_awkward_rows(spark, tables):
    _, labels = tables
    docs = edge_rows.documents(spark, "idiot")
    none = labels.limit(0)
    for op, same in ((toxicity, "toxic"), (cotrain, "quality")):
        rows = op.score(docs, none).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        known = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, None, None), (6, 1, 0), (8, 1, 0), (9, 0, 1), (11, 1, 1), (None, 1, 1)],
                                      "doc_id long, quality int, toxic int")
        rows = op.score(docs, known).collect()
        assert len(rows) == docs.count() and {r["predicted"] for r in rows} <= {0, 1}
        by_text = {r["doc_id"]: r["score"] for r in rows}
        assert by_text[3] == by_text[4] or op is cotrain
        assert op.score(edge_rows.no_documents(spark), known).count() == 0
        keep = toxicity.keep_clean if op is toxicity else cotrain.keep_good
        assert keep(docs, none).columns == docs.columns and keep(docs, none).count() == docs.count(), same
    assert cotrain.text_view(None) == cotrain.text_view("") and len(cotrain.page_view(None, None, None, None)) == 45
    assert list(itertools.islice(toxicity.entries_of("abcdef"), 2)) == ["abcdef", "abcdef*"]


def test_folds(spark):
    import zlib
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 3 for r in df.withColumn("f", learning.fold()).collect())


def test_toxicity_recall_in_every_language(tables):
    docs, labels = tables
    found = (toxicity.score(docs, labels).where("held_out").join(labels.where("toxic = 1"), "doc_id")
             .join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang").avg("predicted").collect())
    assert len(found) == 4 and all(r["avg(predicted)"] >= 0.8 for r in found)


def test_patterns_are_fitted_without_a_lexicon(spark):
    ids = [i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != learning.HELD_OUT][:20]
    docs = spark.createDataFrame([(i, f"kill item{i}" if n % 2 else f"keep item{i}") for n, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).lexicon == {}
    assert all(r["predicted"] == r["toxic"] for r in toxicity.score(docs, labels).join(labels, "doc_id").collect())


def test_targets_beside_insults_and_behind_threats():
    s = toxicity.Scanner({"idiot": 5.0})

    def hit(text):
        return [toxicity.PATTERNS[i] for i in np.flatnonzero(s.features(text))]
    targeted = frozenset({"targeted"})
    assert hit("I will kill you") == hit("we will hurt them") == [("threat", targeted)]
    assert hit("kill the process") == hit("he can kill the process") == [("threat", frozenset())]
    assert hit("idiot you are") == hit("you idiot") == [("insult", targeted)] and hit("what an idiot") == [("insult", frozenset())]
    assert hit("I will not hurt you") == [("threat", targeted | {"negated"})]
    assert hit("he said he would kill them") == [("threat", targeted | {"reported"})]


def test_patterns_without_examples_have_a_prior(spark):
    ids = [i for i in range(150) if zlib.crc32(str(i).encode()) % 3 != learning.HELD_OUT][:60]
    docs = spark.createDataFrame([(i, f"you idiot{i} idiot" if n % 2 else f"fine day {i}") for n, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    threat, harmless, negated, empty = model.scores(["I will kill you", "kill the process", "I will not kill you", ""])
    assert threat > harmless > empty == negated


def random_views(n, seed=3):
    """Rows of the two views' widths; label and views agree, single precision as stored."""
    r = np.random.default_rng(seed)
    y = r.integers(0, 2, n).astype(float)
    widths = len(cotrain.text_view("")), len(cotrain.page_view("", "", "", 0))
    views = [np.concatenate([(y * 2)[:, None] + r.normal(0, 0.8, (n, 2)), r.normal(0, 1, (n, w - 2))], axis=1).astype(np.float32).astype(float)
             for w in widths]
    return views, y


@pytest.mark.parametrize("parts", [1, 7])
def test_exchange_over_spark_equals_the_one_in_memory(spark, parts):
    """All rows of the table take part, however they are partitioned; 150 partitions' sums would meet in groups of 64."""
    x, y = random_views(3000)
    rows = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x[0][300:2500], x[1][300:2500], strict=True)], "a array<float>, b array<float>")
    known, check = [v[:300] for v in x], [v[2500:] for v in x]
    near = cotrain.CoTrained().fit(known, y[:300], [v[300:2500] for v in x], check, y[2500:])
    far = cotrain.CoTrained().fit(known, y[:300], cotrain.over(rows.repartition(parts)), check, y[2500:])
    assert np.allclose(near.scores(*check), far.scores(*check), atol=1e-6)
    assert np.mean((near.scores(*check)[:, 2] > 0.5) == (y[2500:] == 1)) > 0.95
    total = cotrain.over(rows.repartition(150))(cotrain._moments)
    assert total[0] == 2200 and np.allclose(total, cotrain._moments([v[300:2500] for v in x]))
    assert cotrain.over(rows.limit(0))(cotrain._moments)[0] == 0


def test_exchanged_labels_against_a_row_by_row_replay():
    x, y = random_views(600)
    models = [learning.Logistic().fit(v[:40], y[:40]) for v in x]
    rounds = []
    for _ in range(3):
        counts = cotrain._histograms(models, rounds, x).reshape(2, cotrain.BINS)
        rounds.append((models, [cotrain._cuts(c, 30, 20) for c in counts]))
        models = [m.moved(m.sums(v[:40], y[:40], np.ones(40))) for m, v in zip(models, x, strict=True)]
    given, free = cotrain.exchanged(rounds, x)
    for i in range(600):
        want, at = [-1, -1], None
        for ms, cuts in rounds:
            for v in (0, 1):
                place = int(cotrain._bins(ms[v].logit(x[v][i:i + 1]))[0])
                if place <= cuts[v][0] or place >= cuts[v][1]:
                    want[1 - v], at = int(place >= cuts[v][1]), True
            if at:
                break
        assert [g[i] for g in given] == want and free[i] == (at is None)
    assert (~free).sum() >= 100
    low, high = cotrain._cuts(np.ones(cotrain.BINS), 5, 7)
    assert (low + 1, cotrain.BINS - high) == (5, 7)


def test_unlabelled_rows_are_all_outside_the_held_out_fold(spark, tables):
    docs, labels = tables
    known = labels.where("quality is not null")
    want = docs.where(learning.fold() != learning.HELD_OUT).join(known, "doc_id", "left_anti").count()
    assert cotrain.unlabelled_rows(docs, labels).count() == want > 3000
