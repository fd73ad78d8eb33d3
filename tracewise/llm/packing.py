"""Packing documents into sequences: first-fit decreasing over a tournament tree.

Documents are tokenised where they are read and dealt into randomised groups of a
bounded number of bytes. Each group is packed on its own: whole sequences are cut
off the front of a document, the remainders go, longest first, into the first bin
with room (a tournament tree over the bins' free space finds it in O(log bins)),
and pieces of the last bins are then cut to close the gaps of the earlier ones, so
that a group leaves at most one sequence with padding. Groups never talk to each
other and pack their rows by doc_id and tokens, so a lost task is simply run again.
A task takes a fixed number of whole groups, dealt evenly by number, and holds no
more than their ids; nothing is sorted on the way.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.tokens import Vocabulary, json_vocabulary

SEED = 20240501
#: Groups that one task takes.
TASK_GROUPS = 8
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class TournamentTree:
    """Bins by number; each inner node holds the larger free space of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, need: int) -> int:
        """First bin with room for ``need``; its free space shrinks."""
        free, at = self.free, 1
        if free[1] < need:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if free[at] < need:
                at += 1
        found = at - self.leaves
        free[at] -= need
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
        return found


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; items longest first, ties by number."""
    tree = TournamentTree(len(lengths), capacity) if lengths else None
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = tree.place(lengths[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    return bins


def close_gaps(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cut pieces (item, start, length) of the last bins into the gaps of the first ones."""
    first, last = 0, len(bins) - 1
    room = [capacity - sum(p[2] for p in b) for b in bins]
    while first < last:
        if room[first] == 0:
            first += 1
            continue
        item, start, length = bins[last].pop()
        take = min(length, room[first])
        bins[first].append((item, start, take))
        room[first] -= take
        if take < length:
            bins[last].append((item, start + take, length - take))
        elif not bins[last]:
            bins.pop()
            last -= 1
    return bins


def pack_group(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document number, start, length) that hold every token once."""
    whole = [[(i, s, capacity)] for i, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    rest = [(i, n - n % capacity, n % capacity) for i, n in enumerate(lengths) if n % capacity]
    bins = first_fit_decreasing([r[2] for r in rest], capacity)
    return whole + close_gaps([[rest[i] for i in b] for b in bins], capacity)


def id_type(vocabulary: Vocabulary, separator: int) -> str:
    """Ids travel to their groups in two bytes each if every id and the separator fit, else in four."""
    top = max(separator, *vocabulary.ranks.values(), *vocabulary.special.values())
    return "<u2" if top < 1 << 16 else "<u4"


def pack_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = 1024,
                   separator: int = 0, group_bytes: int = 2_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document's tokens are those of its text and ``separator``; a null or empty
    text is the separator alone. ``ids`` holds the piece's tokens as little-endian
    unsigned 32-bit integers. ``sequence_id`` is unique over all groups, ``offset``
    is the piece's place in its sequence, from 0 without gaps. Very long texts
    become many sequences; repeated rows are packed one by one; null ids stay null;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or json_vocabulary()
    kind, vocab = id_type(vocabulary, separator), spark.sparkContext.broadcast(vocabulary)
    total = docs.select(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    groups = max(1, -(-total // group_bytes))
    tasks = -(-groups // TASK_GROUPS)
    dealt = docs.select("doc_id", "text", F.floor(F.rand(SEED) * groups).cast("int").alias("_group"))

    def tokenise(batches):
        encoder, end = vocab.value.encoder, np.array([separator], kind).tobytes()
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = [encoder.encode_to_numpy(t or "", allowed_special="all").astype(kind).tobytes() + end
                       for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["_group"], pa.array(ids, pa.binary())],
                                                 ["doc_id", "_group", "ids"])

    def pack(group, rows):
        # a fixed order, however the rows arrived: a task that runs again packs the same
        rows = sorted(((doc, np.frombuffer(x, kind).astype("<u4").tobytes()) for doc, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        docs_ids, ids = [r[0] for r in rows], [r[1] for r in rows]
        lengths = [len(x) // 4 for x in ids]
        cols: list[list] = [[] for _ in range(7)]
        for n, sequence in enumerate(pack_group(lengths, capacity)):
            at = 0
            for doc, start, length in sequence:
                row = (docs_ids[doc], start, length, lengths[doc], (group << 32) + n, at,
                       ids[doc][4 * start:4 * (start + length)])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
                at += length
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    def pack_groups(batches):
        held = defaultdict(list)
        for batch in batches:
            for doc, group, ids in zip(*(batch[c].to_pylist() for c in ("doc_id", "_group", "ids")), strict=True):
                held[group].append((doc, ids))
        while held:
            yield pack(*held.popitem())

    return (dealt.mapInArrow(tokenise, "doc_id long, _group int, ids binary")
            .repartitionById(tasks, F.col("_group") % tasks).mapInArrow(pack_groups, PIECES))
