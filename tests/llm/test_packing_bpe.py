"""Packing and byte-level BPE against the tokenizer libraries and exact round trips."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.llm import edge_rows
from tracewise.llm import bpe, packing, tokens


def test_tournament_tree_equals_plain_first_fit():
    for seed in range(30):
        r = random.Random(seed)
        sizes = [r.randint(1, 100) for _ in range(r.randint(1, 80))]
        want: list[list[int]] = []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            for b in want:
                if sum(sizes[j] for j in b) + sizes[i] <= 100:
                    b.append(i)
                    break
            else:
                want.append([i])
        assert packing.first_fit_decreasing(sizes, 100) == want


def test_group_keeps_every_token_once():
    for seed in range(20):
        r = random.Random(seed)
        lengths = [r.randint(1, 400) for _ in range(r.randint(1, 60))]
        got = packing.pack_group(lengths, 64)
        seen = Counter()
        for sequence in got:
            assert 0 < sum(p[2] for p in sequence) <= 64
            for doc, start, length in sequence:
                seen.update((doc, k) for k in range(start, start + length))
        assert seen == Counter((i, k) for i, n in enumerate(lengths) for k in range(n))
        assert sum(sum(p[2] for p in s) < 64 for s in got) <= 1


def test_pieces_are_the_library_tokens(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = edge_rows.documents(spark)
    rows = packing.pack_documents(docs, capacity=128, group_bytes=20_000).collect()
    want = Counter()
    for d in docs.collect():
        ids = [*t.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        want[d["doc_id"], tuple(ids)] += 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for doc, pieces in by_doc.items():
        whole = [w for (i, w), n in want.items() if i == doc for _ in range(n)]
        assert sum(r["length"] for r in pieces) == sum(map(len, whole))
        for r in pieces:
            got = np.frombuffer(r["ids"], "<u4").tolist()
            assert r["doc_tokens"] == len(whole[0]) and got == list(whole[0][r["start"]:r["start"] + r["length"]])
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack_documents(edge_rows.no_documents(spark)).count() == 0


def test_a_task_takes_a_fixed_number_of_groups(spark):
    docs = spark.range(1200).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 12) AS text")
    pieces = packing.pack_documents(docs, capacity=64, group_bytes=2_000).selectExpr("*", "shiftright(sequence_id, 32) AS g", "spark_partition_id() AS p")
    by_task = defaultdict(set)
    for r in pieces.collect():
        by_task[r["p"]].add(r["g"])
    assert max(map(len, by_task.values())) <= packing.TASK_GROUPS < len(set().union(*by_task.values()))
    assert sum(map(len, by_task.values())) == len(set().union(*by_task.values()))


@pytest.mark.parametrize("separator, kind", [(0, "<u2"), (65_535, "<u2"), (65_536, "<u4"), (2 ** 32 - 1, "<u4")])
def test_ids_beyond_two_bytes_stay_whole(spark, separator, kind):
    v = tokens.json_vocabulary()
    assert packing.id_type(v, separator) == kind
    docs = edge_rows.documents(spark).where("doc_id IN (2, 4, 6)")
    got = defaultdict(list)
    for r in packing.pack_documents(docs, v, capacity=32, separator=separator, group_bytes=200).orderBy("start").collect():
        got[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert got == {d["doc_id"]: [*v.encoder.encode(d["text"], allowed_special="all"), separator] for d in docs.collect()}


def test_query_checksum(spark):
    rows = packing.pack_documents(edge_rows.documents(spark).where("doc_id = 9")).selectExpr("ids", "crc32(ids) AS c").collect()
    assert [r["c"] for r in rows] == [zlib.crc32(rows[0]["ids"])]


@pytest.mark.parametrize("block_chars", [100, 10_000_000])
def test_bpe_equals_the_library_and_round_trips(spark, block_chars):
    import tiktoken
    v = tokens.rank_vocabulary()
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    docs = edge_rows.documents(spark)
    coded = bpe.encode(docs, block_chars=block_chars)
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in coded.collect())
    want = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    assert got == want
    back = Counter((r["doc_id"], bytes(r["bytes"])) for r in bpe.decode(coded).collect())
    assert back == Counter((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect())
    assert bpe.encode(edge_rows.no_documents(spark)).count() == 0


def test_bpe_on_random_unicode(spark):
    import tiktoken
    v = tokens.rank_vocabulary()
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    r = random.Random(5)
    texts = ["".join(r.choice(" \n\t'srtlve0a1éßñж中🙂٣.,!  ́") for _ in range(200)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in bpe.digests(df).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_latin_splitter_equals_the_pattern():
    import regex
    assert tokens.USUAL_PATTERN == public_tokenizers.PATTERN
    every, latin = regex.compile(public_tokenizers.PATTERN).findall, tokens.latin_pattern().findall
    for c in map(chr, range(256)):
        for text in (c, f"a{c}b", f" {c}{c} ", f"1{c}'s", f"\n{c}\t"):
            assert every(text) == latin(text)
    r = random.Random(8)
    for _ in range(500):
        text = "".join(chr(r.randrange(256)) if r.random() < 0.5 else r.choice(" 'stre\n1") for _ in range(60))
        assert every(text) == latin(text)


def test_rank_coding_round_trips():
    r = np.random.default_rng(1)
    for top in (1, 150, 300, 15_000, 20_000, 2 ** 24):
        a = r.integers(0, top, 4000).astype(np.uint32)
        assert (bpe.unpack_ranks(bpe.pack_ranks(a)) == a).all()
    edges = np.array([0, 199, 200, 14279, 14280, 14281, 2 ** 24], np.uint32)
    assert (bpe.unpack_ranks(bpe.pack_ranks(edges)) == edges).all() and len(bpe.unpack_ranks(bpe.pack_ranks(edges[:0]))) == 0
