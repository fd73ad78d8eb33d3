"""Quality classifier by co-training.

Two views of a document are learned apart: what the text is made of (characters,
words, repetition) and what is known about its page (source, language, size, lines).
In each round either classifier labels the unlabelled documents it is surest of and
hands them to the other. Both are then calibrated on labelled rows that neither has
learned from; as the views are taken to be independent given the quality, their
log-odds add up (less the prior's) to the score of every document, in the task that
reads it.

Labelled rows are a bounded sample. The exchange covers every unlabelled document: the
features of all of them are written once, each round counts how sure either classifier
is of them (a histogram) and refits by Newton steps on sums over them. Which labels a
document was given follows from the models and cuts of the rounds so far, so a task
that is run again finds the same ones and no state is kept. The driver sees the
labelled rows' features and one row of sums per 64 partitions.
"""

from __future__ import annotations

import operator
import string
import zlib
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import materialize
from tracewise.llm.learning import HELD_OUT, Logistic, fold, labelled_sample, sigmoid

MOST_LABELLED = 12_000     # labelled rows that are learned from
ROUNDS = 5
STEPS = 3                  # Newton steps over the unlabelled documents a round
SURE, LIMIT, FINE = 2, 20, 16   # log-odds that count as sure; histograms hold +-LIMIT in 1/FINE
BINS = 2 * LIMIT * FINE
THRESHOLD = 0.4            # a document is rejected below this, in doubt it stays
SHRINK = 200               # characters of nothing added to every text: shares in short texts count less
COLUMNS = ["text", "lang", "source", "n_chars"]
SOURCE_BUCKETS, LANG_BUCKETS = 32, 8
MARKS = [ord(c) for c in string.punctuation]


def text_view(text: str | None) -> list[float]:
    """Shares of character kinds, and how much words and lines repeat, over the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw) + SHRINK
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    m = len(words) + SHRINK / 10
    shares = [seen[65:91].sum(), seen[48:58].sum(), seen[10], seen[128:].sum(), *seen[MARKS]]
    again = sum(map(operator.eq, words, words[1:])) / m
    return [*np.log1p(1000 * np.array(shares) / n).tolist(), (len(words) - len(set(words))) / m, np.sqrt(again), len(raw) / m, np.log1p(m)]


def page_view(text: str | None, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Source and language by bucket, stated size, and the page's lines."""
    lines = [x for x in (text or "").split("\n") if x]
    long = [len(x) for x in lines] or [0]
    of = [0.0] * (SOURCE_BUCKETS + LANG_BUCKETS)
    of[zlib.crc32((source or "").encode()) % SOURCE_BUCKETS] = 1.0
    of[SOURCE_BUCKETS + zlib.crc32((lang or "").encode()) % LANG_BUCKETS] = 1.0
    size = len(text or "") if n_chars is None else max(0, n_chars)
    return [*of, np.log1p(size), np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(float(np.mean(long))), np.log1p(max(long))]


def views(rows) -> tuple[np.ndarray, np.ndarray]:
    """rows: (text, lang, source, n_chars)."""
    pairs = [(text_view(r[0]), page_view(*r)) for r in rows]
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])


def _bins(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((logit + LIMIT) * FINE), 0, BINS - 1).astype(int)


def exchanged(rounds: list, x: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Labels given to the rows after ``rounds`` of (models, cuts): per view's pool -1 (none), 0 or 1; and which rows got none."""
    given = [np.full(len(x[0]), -1) for _ in (0, 1)]
    free = np.ones(len(x[0]), bool)
    for models, cuts in rounds:
        used = np.zeros(len(free), bool)
        for v in (0, 1):
            sure = _bins(models[v].logit(x[v]))
            for label, picked in enumerate((free & (sure <= cuts[v][0]), free & (sure >= cuts[v][1]))):
                given[1 - v][picked] = label
                used |= picked
        free &= ~used
    return given, free


def _moments(x: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[len(x[0])], *[part for v in x for part in (v.sum(axis=0), (v * v).sum(axis=0))]])


def _histograms(models: list[Logistic], rounds: list, x: list[np.ndarray]) -> np.ndarray:
    free = exchanged(rounds, x)[1]
    return np.concatenate([np.bincount(_bins(m.logit(v[free])), minlength=BINS) for m, v in zip(models, x, strict=True)]).astype(float)


def _pool_sums(models: list[Logistic], rounds: list, weight: float, x: list[np.ndarray]) -> np.ndarray:
    given = exchanged(rounds, x)[0]
    return np.concatenate([m.sums(v[g >= 0], g[g >= 0], np.full((g >= 0).sum(), weight)) for m, v, g in zip(models, x, given, strict=True)])


def _cuts(counts: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """The bins up to and from which rows are taken: whole bins until ``low`` and ``high`` rows are reached, sure ones only."""
    least, most = (LIMIT - SURE) * FINE - 1, (LIMIT + SURE) * FINE
    return (min(least, int(np.searchsorted(np.cumsum(counts), low))),
            max(most, BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), high))))


def in_memory(x: list[np.ndarray]) -> Callable:
    return lambda kernel: kernel(x)


def over(rows: DataFrame) -> Callable:
    """The sum of a kernel over all blocks of stored ``rows`` (a, b), added in the order of their partitions."""
    widths = len(text_view("")), len(page_view("", "", "", 0))

    def total(kernel: Callable) -> np.ndarray:
        def blocks(batches):
            sums = None
            for batch in batches:
                x = [batch[c].flatten().to_numpy().reshape(-1, w).astype(float) for c, w in zip("ab", widths, strict=True)]
                sums = kernel(x) if sums is None else sums + kernel(x)
            if sums is not None:
                yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

        def merged(parts: pa.Table) -> pa.Table:
            ordered = parts.sort_by("part")
            sums = np.sum(ordered["sums"].to_pylist(), axis=0)
            return pa.table({"part": ordered["part"][:1], "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

        shape = "part int, sums array<double>"
        found = rows.mapInArrow(blocks, shape).groupBy(F.floor(F.col("part") / 64)).applyInArrow(merged, shape).collect()
        return sum((np.array(r["sums"]) for r in sorted(found)), kernel([np.zeros((0, w)) for w in widths]))

    return total


class CoTrained:
    """The two classifiers and their calibration."""

    def __init__(self, rounds: int = ROUNDS, share: float = 0.05):
        self.rounds, self.share = rounds, share
        self.models: list[Logistic] | None = None

    def fit(self, labelled: list[np.ndarray], y: np.ndarray, unlabelled: list[np.ndarray] | Callable, check: list[np.ndarray],
            check_y: np.ndarray) -> CoTrained:
        """``unlabelled``: the two views' rows, or a function that sums a kernel over them (``over``).

        A pseudo-labelled row weighs as much as the labelled ones divided among all
        unlabelled rows, and never more than a labelled one, so that however many there
        are, the labelled rows are not drowned.
        """
        if len(set(y.tolist())) < 2 or len(set(check_y.tolist())) < 2:
            return self
        total = unlabelled if callable(unlabelled) else in_memory(unlabelled)
        moments = total(_moments)
        n, prior, scaling = int(moments[0]), y.mean(), []
        all_rows = moments + _moments(labelled)
        at = 1
        for x in labelled:
            w = x.shape[1]
            mean, square = all_rows[at:at + w] / all_rows[0], all_rows[at + w:at + 2 * w] / all_rows[0]
            scaling.append((mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6))
            at += 2 * w
        models = [Logistic().fit(x, y, scaling=s) for x, s in zip(labelled, scaling, strict=True)]
        weight, take = min(1.0, len(y) / max(1, n)), max(1, int(self.share * n))
        rounds = []
        for _ in range(self.rounds if n else 0):
            counts = total(partial(_histograms, models, rounds)).reshape(2, BINS)
            cuts = [_cuts(c, max(1, round(take * (1 - prior))), max(1, round(take * prior))) for c in counts]
            if not any(c[:low + 1].sum() + c[high:].sum() for c, (low, high) in zip(counts, cuts, strict=True)):
                break
            rounds.append((models, cuts))
            for _ in range(STEPS):
                sums, at, moved = total(partial(_pool_sums, models, rounds, weight)), 0, []
                for m, x in zip(models, labelled, strict=True):
                    own = m.sums(x, y, np.ones(len(y)))
                    moved.append(m.moved(own + sums[at:at + len(own)]))
                    at += len(own)
                models = moved
        self.models = models
        self.prior = float(np.log(max(check_y.mean(), 1e-6) / max(1 - check_y.mean(), 1e-6)))
        logits = [m.logit(check[v])[:, None] for v, m in enumerate(self.models)]
        self.calibration = [Logistic(0.1).fit(z, check_y) for z in logits]
        return self

    def scores(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        """(text view, page view, combined) probabilities of good quality; 1 where nothing could be learned."""
        if self.models is None or not len(text):
            return np.ones((len(text), 3))
        each = [c.logit(m.logit(x)[:, None]) for c, m, x in zip(self.calibration, self.models, (text, page), strict=True)]
        return sigmoid(np.stack([*each, each[0] + each[1] - self.prior], axis=1))


def view_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, y, a, b): the two views of every row."""
    def features(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                a, b = views(list(zip(*(part[c].to_pylist() for c in COLUMNS), strict=True)))
                lists = [pa.array(x.astype(np.float32).tolist(), pa.list_(pa.float32())) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["y"], *lists], ["doc_id", "y", "a", "b"])

    return docs.select("doc_id", "y", *COLUMNS).mapInArrow(features, "doc_id long, y int, a array<float>, b array<float>")


def unlabelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored views (a, b) of every row outside the held-out fold whose id has no label; views are joined with ids, not texts."""
    ids = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    rows = view_rows(docs.where(fold() != HELD_OUT).withColumn("y", F.lit(None).cast("int")))
    return materialize(rows.join(ids, "doc_id", "left_anti").select("a", "b"), "cotrain-unlabelled")


def learn(docs: DataFrame, labels: DataFrame, labelled: int = MOST_LABELLED) -> CoTrained:
    """Co-train on a bounded sample of labelled rows and all unlabelled ones; a fifth of the labelled rows is kept for calibration."""
    docs = docs.select("doc_id", *COLUMNS)
    known = view_rows(labelled_sample(docs, labels, "quality", labelled, COLUMNS)).collect()
    known.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["a"]))
    cut = len(known) // 5
    check, train = known[:cut], known[cut:]

    def pair(some):
        widths = len(text_view("")), len(page_view("", "", "", 0))
        return [np.array([r[c] for r in some], float).reshape(len(some), w) for c, w in zip("ab", widths, strict=True)]

    return CoTrained().fit(pair(train), np.array([r["y"] for r in train], float), over(unlabelled_rows(docs, labels)), pair(check),
                           np.array([r["y"] for r in check], float))


def score(docs: DataFrame, labels: DataFrame, **most: int) -> DataFrame:
    """One row per document: doc_id, held_out, text_score, page_score, score (0 to 1: good quality), predicted.

    Null texts are read as empty, null languages and sources as empty strings, a null
    n_chars as the text's length; texts of any length are read whole; repeated rows
    score alike; without labelled rows of both kinds every score is 1; an empty table
    gives no rows; other columns of ``docs`` are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, **most))

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                s = model.value.scores(*views(list(zip(*(part[c].to_pylist() for c in COLUMNS), strict=True))))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *map(pa.array, s.T.copy())], ["doc_id", "text_score", "page_score", "score"])

    scored = docs.select("doc_id", *COLUMNS).mapInArrow(run, "doc_id long, text_score double, page_score double, score double")
    return scored.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "text_score", "page_score", "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **most: int) -> DataFrame:
    """``docs`` without the rows scored below THRESHOLD; all columns pass through."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, **most))

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                s = model.value.scores(*views(list(zip(*(part[c].to_pylist() for c in COLUMNS), strict=True))))
                yield part.filter(pa.array(s[:, 2] >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
