"""Byte-level BPE over a global shuffle of distinct words.

Pre-tokens are exploded with their positions block by block: a block (some
megabytes of whole documents) keeps, per document, the sequence of its local word
numbers, and the sorted list of its distinct words. The word lists are dealt by
word hash, so each distinct word of the corpus meets in one task and is encoded
once; the ids go back to the blocks, where positions put the documents together.
Positions and word lists travel packed, not one row per pre-token.

A block with a third of all words, or a word in every document, costs one entry
per block and word at most. Blocks are numbered by task and order of reading and
words by their sorted order, so a task that is run again sends the same rows.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.tokens import Vocabulary, rank_vocabulary

BLOCK_CHARS = 16_000_000
BLOCKS = "block long, bucket int, kind int, doc_ids array<long>, lens binary, data binary, order binary"
WORDS_AT_ONCE = 300_000
BUCKET_BYTES = 256 << 20   # bytes of text that a word bucket serves at most


def squeeze(a: np.ndarray) -> bytes:
    """Non-negative integers below 2^32, low and high halves apart, compressed."""
    a = a.astype("<u4")
    return zstandard.compress((a & 0xFFFF).astype("<u2").tobytes() + (a >> 16).astype("<u2").tobytes(), 3)


def spread(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), "<u2")
    half = len(raw) // 2
    return raw[:half] | (raw[half:].astype("<u4") << 16)


ONE_BYTE, TWO_BYTES = 200, 55      # codes of one byte; first bytes of codes of two bytes; 255 starts one of four


def pack_ranks(a: np.ndarray) -> bytes:
    """Frequency ranks in one, two or four bytes, byte by byte apart, compressed."""
    wide = ONE_BYTE + TWO_BYTES * 256
    one, two = a < ONE_BYTE, (a >= ONE_BYTE) & (a < wide)
    first = np.full(len(a), 255, np.uint8)
    first[one] = a[one]
    middle, rest = a[two] - ONE_BYTE, a[~(one | two)] - wide
    first[two] = ONE_BYTE + (middle >> 8)
    planes = [first, middle & 255, *((rest >> k) & 255 for k in (0, 8, 16))]
    parts = [zstandard.compress(x.astype(np.uint8).tobytes(), 3) for x in planes]
    return array("I", map(len, parts)).tobytes() + b"".join(parts)


def unpack_ranks(data: bytes) -> np.ndarray:
    ends = np.cumsum(np.frombuffer(data[:20], "<u4"), dtype=np.int64) + 20
    planes = [np.frombuffer(zstandard.decompress(data[a:b]), np.uint8).astype(np.uint32)
              for a, b in zip([20, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    out = planes[0].copy()
    two, rest = (out >= ONE_BYTE) & (out < 255), out == 255
    out[two] = ONE_BYTE + ((out[two] - ONE_BYTE) << 8) + planes[1]
    out[rest] = ONE_BYTE + TWO_BYTES * 256 + planes[2] + (planes[3] << 8) + (planes[4] << 16)
    return out


def gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """values[starts[0]:starts[0]+lens[0]], values[starts[1]:...], ... in one array."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lens), lens)
    return values[np.arange(total, dtype=np.int64) + shift]


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "bucket": pa.int32(), "kind": pa.int32(), "doc_ids": pa.list_(pa.int64()),
             "lens": pa.binary(), "data": pa.binary(), "order": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()})


def block_rows(block: int, doc_ids: list, token_lens: list[int], numbers: list[np.ndarray], words: dict[str, int], buckets: int):
    """The position row (kind 0) and one word-list row (kind 1) per bucket.

    Words are renumbered by falling frequency (then by word), which makes positions
    short, and a bucket's list is in that order; the position row keeps the bucket of
    every word (``order``), so lists need no numbers of their own.
    """
    numbers = np.concatenate(numbers)
    if len(words) > ONE_BYTE + TWO_BYTES * 256 + 2 ** 24:
        raise ValueError("one block holds too many distinct words; lower block_chars")
    listed = sorted(words)
    old = np.fromiter(map(words.__getitem__, listed), np.int64, len(listed))
    order = np.argsort(-np.bincount(numbers, minlength=len(listed))[old], kind="stable")
    new = np.empty(len(listed), np.uint32)
    new[old[order]] = np.arange(len(listed), dtype=np.uint32)
    raw = [listed[i].encode() for i in order.tolist()]
    bucket = np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % buckets
    yield _rows([{"block": block, "bucket": block * 7919 % buckets, "kind": 0, "doc_ids": doc_ids,
                  "lens": squeeze(np.array(token_lens, np.int64)), "data": pack_ranks(new[numbers]), "order": squeeze(bucket)}])
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        mine = [raw[i] for i in by_bucket[cuts[b]:cuts[b + 1]].tolist()]
        yield _rows([{"block": block, "bucket": b, "kind": 1,
                      "lens": squeeze(np.array(list(map(len, mine)))), "data": zstandard.compress(b"".join(mine), 9)}])


def id_lists(doc_ids: list, ids: np.ndarray, offsets: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()),
                     "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))})


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, buckets: int | None = None, block_chars: int = BLOCK_CHARS,
           finish: Callable[[list, np.ndarray, np.ndarray], pa.Table] = id_lists,
           schema: str = "doc_id long, ids array<int>") -> DataFrame:
    """One row per document: doc_id, ids (array of int).

    ``finish(doc_ids, ids, offsets)`` makes the rows of some whole documents, whose
    ids are ids[offsets[i]:offsets[i + 1]]; ``schema`` describes them. A null text is
    empty and has no ids; texts of any length stay whole; repeated rows are encoded
    row by row; null ids stay null; an empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(vocabulary or rank_vocabulary())
    if buckets is None:       # a bucket's share of the input is bounded, so its group is
        size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def explode(batches):
        split = vocab.value.splitter
        task, n = TaskContext.get().partitionId(), 0
        words, ids, lens, numbers, chars = {}, [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = text.as_py() or ""
                found = split(text)
                for w in set(found).difference(words):
                    words[w] = len(words)
                ids.append(doc)
                lens.append(len(found))
                numbers.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                chars += len(text)
                if chars >= block_chars:
                    yield from block_rows((task << 32) + n, ids, lens, numbers, words, buckets)
                    words, ids, lens, numbers, chars, n = {}, [], [], [], 0, n + 1
        if ids:
            yield from block_rows((task << 32) + n, ids, lens, numbers, words, buckets)

    def encode_words(key, tab):
        """All word lists of one bucket: each distinct word is encoded once, then looked up per list."""
        known: dict[bytes, bytes] = {}
        encoder = vocab.value.encoder
        for batch in tab.to_batches():
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                if row["kind"][0].as_py() == 0:
                    yield row
                    continue
                ends = np.cumsum(spread(row["lens"][0].as_py()), dtype=np.int64).tolist()
                raw = zstandard.decompress(row["data"][0].as_py())
                words = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                new = list(set(words).difference(known))
                for w, e in zip(new, encoder.encode_ordinary_batch([w.decode() for w in new], num_threads=1), strict=True):
                    known[w] = array("I", e).tobytes()
                got = list(map(known.__getitem__, words))
                yield _rows([{"block": row["block"][0].as_py(), "bucket": key[0].as_py(), "kind": 1,
                              "lens": squeeze(np.array(list(map(len, got))) // 4), "data": squeeze(np.frombuffer(b"".join(got), "<u4"))}])

    def assemble(key, tab):
        """Ids of a block's documents, by position; some documents at a time."""
        rows = tab.to_pylist()
        place = next(r for r in rows if r["kind"] == 0)
        lists = sorted((r["bucket"], r["lens"], r["data"]) for r in rows if r["kind"] == 1)
        listed = np.concatenate([spread(x[1]) for x in lists]).astype(np.int64) if lists else np.zeros(0, np.int64)
        ids = np.concatenate([spread(x[2]) for x in lists]) if lists else np.zeros(0, np.uint32)
        rank = np.argsort(spread(place["order"]), kind="stable")       # of each word, list after list
        lens, starts = np.empty_like(listed), np.empty_like(listed)
        lens[rank], starts[rank] = listed, np.cumsum(listed) - listed
        doc_ids, numbers = place["doc_ids"], unpack_ranks(place["data"])
        cuts = np.concatenate([[0], np.cumsum(spread(place["lens"]), dtype=np.int64)])
        first = 0
        while first < len(doc_ids):
            last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + WORDS_AT_ONCE, "right")) - 1)
            mine = numbers[cuts[first]:cuts[last]]
            ends = np.concatenate([[0], np.cumsum(lens[mine])])
            yield from finish(doc_ids[first:last], gather(ids, starts[mine], lens[mine]), ends[cuts[first:last + 1] - cuts[first]]).to_batches()
            first = last

    exploded = docs.select("doc_id", "text").mapInArrow(explode, BLOCKS)
    coded = exploded.groupBy("bucket").applyInArrow(lambda key, tab: pa.Table.from_batches(encode_words(key, tab), tab.schema), BLOCKS)
    return coded.groupBy("block").applyInArrow(lambda key, tab: pa.Table.from_batches(assemble(key, tab)), schema)


def token_text(ids: np.ndarray, table: dict[int, bytes]) -> bytes:
    """The bytes that ids stand for: each id joined with the token-byte table."""
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Replace ``ids`` by ``bytes``: every id joined with the token-byte table (fixed size, broadcast)."""
    vocab = encoded.sparkSession.sparkContext.broadcast(vocabulary or rank_vocabulary())
    others = [f for f in encoded.schema.fields if f.name not in ("ids", "bytes")]

    def join_bytes(batches):
        table = vocab.value.token_bytes
        for batch in batches:
            out = [token_text(row.values.to_numpy(), table) if row.is_valid else None for row in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch[f.name] for f in others] + [pa.array(out, pa.binary())],
                                             [f.name for f in others] + ["bytes"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["bytes binary"])
    return encoded.mapInArrow(join_bytes, schema)


def digests(docs: DataFrame, vocabulary: Vocabulary | None = None, **blocks: int) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode(), and the same decoding as decode(), without moving the ids again."""
    vocabulary = vocabulary or rank_vocabulary()
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def finish(doc_ids, ids, offsets):
        table = vocab.value.token_bytes
        parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        shown = vocab.value.decimals
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                         "ids_sha256": [hashlib.sha256(b",".join(map(shown.__getitem__, p.tolist()))).hexdigest() for p in parts],
                         "decoded_sha256": [hashlib.sha256(token_text(p, table)).hexdigest() for p in parts]})

    return encode(docs, vocabulary, finish=finish, schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", **blocks)
