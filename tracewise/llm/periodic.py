"""Periodic runs of words by internal pattern matching.

The words of many texts are named by number (a text's names are its own, so texts never
match each other) and laid end to end. Prefix doubling gives their suffix array and, at
every doubling, the rank of each dyadic block, which is where the block's interval of
the suffix array begins; the same ranks answer how far two places agree.

Blocks of 4, 8, 16, ... words, half a block apart, then look for their next occurrences:
the range successor in a block's interval, answered by a wavelet tree over the suffix
array, is its first occurrence in the neighbouring window. Occurrences at most half a
block apart form a progression, whose end follows from one comparison; the distances of
all members are the candidate periods. A run of period q is at least 2q long, so it
holds a block and the block's copy q words on: q from 1 to 10 meets in blocks of 4,
q from 3L/2 - 1 to 3L - 2 in blocks of L. Candidates are extended both ways; of equal
stretches the smallest period stays. All work is n log n in the words of a task's batch,
however periodic the texts are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import text_or_empty

LEAST = 12                  # words of a run at least
BATCH_WORDS = 200_000       # words that are searched at a time (a longer text is searched alone)
PAIRS = 1 << 20             # candidates that are looked at together, about
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixRanks:
    """Suffix array of words laid end to end, and the ranks of all dyadic blocks.

    ``ranks[k][i]`` is the start of the suffix array interval of the 2**k words from i;
    equal ranks at two places mean equal blocks (a block that its text cuts off equals none).
    """

    def __init__(self, words: np.ndarray, text_end: np.ndarray):
        n = len(words)
        sa = np.argsort(words, kind="stable").astype(np.int64)
        named = words[sa]
        first = np.ones(n, bool)
        first[1:] = named[1:] != named[:-1]
        starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank = np.full(n + 1, -1, np.int64)
        rank[sa] = starts
        self.ranks, width = [rank], 1
        while True:
            group = self.ranks[-1][sa]
            same = group[1:] == group[:-1]
            open_ = np.zeros(n, bool)
            open_[1:] |= same
            open_[:-1] |= same
            at = np.flatnonzero(open_)
            if not len(at):
                break
            place, of = sa[at], group[at]
            behind = place + width
            after = np.where(behind < text_end[place], self.ranks[-1][np.minimum(behind, n)], -1)
            order = np.argsort(of * (n + 2) + after + 1, kind="stable")
            place, of, after = place[order], of[order], after[order]
            sa[at] = place
            new = np.ones(len(at), bool)
            new[1:] = (of[1:] != of[:-1]) | (after[1:] != after[:-1])
            rank = self.ranks[-1].copy()
            rank[place] = np.maximum.accumulate(np.where(new, at, 0))
            self.ranks.append(rank)
            width *= 2
        self.sa = sa

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on (i and j differ)."""
        i, j = i.copy(), j.copy()
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            step = np.where(self.ranks[k][i] == self.ranks[k][j], 1 << k, 0)
            found += step
            i += step
            j += step
        return found

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j (i < j)."""
        i, j = i.copy(), j.copy()
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i - (1 << k), j - (1 << k)
            step = np.where((a >= 0) & (self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(b, 0)]), 1 << k, 0)
            found += step
            i -= step
            j -= step
        return found


class WaveletTree:
    """Range successor over an array of numbers, level by level from the highest bit (the nodes of a level lie side by side)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels, self.limit = [], 1 << bits
        for b in range(bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(zero, out=before[1:])
            self.levels.append((b, before, int(before[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value >= ``least`` at places [left, right), else -1."""
        lo, hi = left.copy(), right.copy()
        smaller = np.zeros(len(lo), np.int64)
        for b, before, zeros in self.levels:
            one = (least >> b) & 1 == 1
            zl, zr = before[lo], before[hi]
            smaller += np.where(one, zr - zl, 0)
            lo, hi = np.where(one, zeros + lo - zl, zl), np.where(one, zeros + hi - zr, zr)
        there = (smaller < right - left) & (least < self.limit)
        lo, hi, nth = left.copy(), right.copy(), np.where(there, smaller, 0)
        value = np.zeros(len(lo), np.int64)
        for b, before, zeros in self.levels:
            zl, zr = before[lo], before[hi]
            one = nth >= zr - zl
            value += np.where(one, 1 << b, 0)
            nth = np.where(one, nth - (zr - zl), nth)
            lo, hi = np.where(one, zeros + lo - zl, zl), np.where(one, zeros + hi - zr, zr)
        return np.where(there, value, -1)


def candidates(index: SuffixRanks, tree: WaveletTree, kept: np.ndarray, level: int, blocks: np.ndarray,
               counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the blocks of 2**level words at ``blocks`` and their occurrences in the window behind them.

    ``kept`` counts, for every place of the suffix array, the entries before it that the tree holds;
    ``counts`` the length of the interval that begins at a place.
    """
    size = 1 << level
    low, high = (1, 10) if level == 2 else (3 * size // 2 - 1, 3 * size - 2)
    rank = index.ranks[level]
    at = blocks[counts[rank[blocks]] > 1]
    left, right = kept[rank[at]], kept[rank[at] + counts[rank[at]]]
    least, last = at + low, at + high
    places, gaps = [], []
    while len(at):
        found = tree.successor(left, right, least)
        near = (found >= 0) & (found <= last)
        at, left, right, last, found = (x[near] for x in (at, left, right, last, found))
        follow = tree.successor(left, right, found + 1)
        more = (follow >= 0) & (follow <= last)
        step = np.where(more, follow - found, 1)
        chain = more & (step <= size // 2)
        length = np.ones(len(at), np.int64)               # members of the progression inside the window
        agree = index.ahead(found[chain], follow[chain])
        length[chain] = 1 + np.minimum((agree + step[chain] - size) // step[chain], (last[chain] - found[chain]) // step[chain])
        nth = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        places.append(np.repeat(at, length))
        gaps.append(np.repeat(found - at, length) + nth * np.repeat(step, length))
        least = np.where(chain, found + length * step - step + 1, follow)
        at, left, right, last, least = (x[more] for x in (at, left, right, last, least))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *gaps])


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, over the texts' words laid end to end; by start, then period."""
    names, ends, total = [], [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        own = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
        names.append(own + total)                         # names of a text lie apart from all others
        total += len(words)
        ends.append(np.full(len(words), total, np.int64))
    none = np.zeros(0, np.int64)
    if not total:
        return none, none, none
    index = SuffixRanks(np.concatenate(names), np.concatenate(ends))
    if len(index.ranks) < 3:                              # no four words occur twice in a text
        return none, none, none
    rank = index.ranks[2]
    again = np.bincount(rank[:-1], minlength=total)[rank[index.sa]] > 1
    kept = np.concatenate([[0], np.cumsum(again)])
    tree = WaveletTree(index.sa[again], total.bit_length())
    found = [np.zeros((3, 0), np.int64)]
    for level in range(2, len(index.ranks)):
        counts = np.bincount(index.ranks[level][:-1], minlength=total + 1)
        blocks, together = np.arange(0, total, 1 << level >> 1), max(1, PAIRS >> level)
        for i in range(0, len(blocks), together):
            place, period = candidates(index, tree, kept, level, blocks[i:i + together], counts)
            start = place - index.back(place, place + period)
            end = place + period + index.ahead(place, place + period)
            long = end - start >= np.maximum(least, 2 * period)
            found.append(smallest_periods(start[long], end[long], period[long]))
    start, end, period = smallest_periods(*np.concatenate(found, axis=1))
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def smallest_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of equal stretches the smallest period."""
    stretch = start * (int(end.max(initial=0)) + 1) + end
    order = np.lexsort((period, stretch))
    first = np.ones(len(order), bool)
    first[1:] = np.diff(stretch[order]) != 0
    return np.stack([start, end, period])[:, order[first]]


def search(texts: list[bytes], least: int = LEAST) -> tuple[list[int], list[list[dict]], list[bytes]]:
    """Number of words, runs and collapsed text of each UTF-8 text."""
    words = [t.split() for t in texts]                    # ASCII white space: \x20 and \x09 to \x0D
    lengths = np.array([len(w) for w in words], np.int64)
    base = np.concatenate([[0], np.cumsum(lengths)])
    start, end, period = find_runs(words, least)
    of = np.searchsorted(base, start, "right") - 1
    drop = np.zeros(base[-1] + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, end, -1)
    dropped = np.cumsum(drop)[:-1] > 0
    runs: list[list[dict]] = [[] for _ in texts]
    for d, s, e, q in zip(of.tolist(), (start - base[of]).tolist(), (end - base[of]).tolist(), period.tolist(), strict=True):
        runs[d].append({"start": s, "length": e - s, "period": q})
    collapsed = []
    for d, w in enumerate(words):
        if runs[d]:
            w = [x for x, gone in zip(w, dropped[base[d]:base[d + 1]].tolist(), strict=True) if not gone]
        collapsed.append(b" ".join(w))
    return lengths.tolist(), runs, collapsed


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period), collapsed text per row of ``docs``.

    A run is a stretch of at least max(least, 2q) words with smallest period q that no
    neighbour extends; the collapsed text leaves out every word that a run holds after
    its first q words. ``least`` is 12 or more. A null or empty text has no words, no
    runs and an empty collapsed text; texts of any length are searched as wholes;
    repeated rows give the same result each; null ids stay null; an empty table
    gives no rows; other columns are ignored.
    """
    if least < LEAST:
        raise ValueError(f"runs of fewer than {LEAST} words are not searched")
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0

            def result():
                n, runs, collapsed = search(texts, least)
                return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(runs, run_type),
                                                   pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

            for doc_id, text in zip(batch["doc_id"], batch["raw"], strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= 6 * BATCH_WORDS:               # about six bytes a word
                    yield result()
                    ids, texts, size = [], [], 0
            if ids:
                yield result()

    found = docs.select("doc_id", text_or_empty().cast("binary").alias("raw")).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """For a tenth of the ids the words from a place on repeat with a period that the id decides."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the texts of a tenth of the ids are periodic from a place on.

    A null text is empty and stays so; a null id counts as no digits; other columns are ignored.
    """
    def run(batches):
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            texts = [t if zlib.crc32(b"" if i is None else str(i).encode()) % 10 else b" ".join(planted_words(t.split(), i))
                     for i, t in zip(ids, batch["raw"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.binary())], ["doc_id", "raw"])

    made = docs.select("doc_id", text_or_empty().cast("binary").alias("raw")).mapInArrow(run, "doc_id long, raw binary")
    return made.select("doc_id", F.col("raw").cast("string").alias("text"))
