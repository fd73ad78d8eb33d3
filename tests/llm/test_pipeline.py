"""The corpus pipeline: each stage judged on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm import edge_rows
from tests.llm.test_sigtree import brute
from tracewise.llm import packing, secrets

SF = "/root/testdata/sf0.01"


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name == "packing":
            sizes = {d: n for d, n in out.groupBy("doc_id").sum("length").collect()}
            assert set(sizes) == set(before)
            again = {r["doc_id"]: r["doc_tokens"] for r in out.collect()}
            assert sizes == again and max(r[0] for r in out.selectExpr("offset + length").collect()) <= 1024
            break
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out = out.persist()
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "near_duplicates":
            want = {int(c) for _, _, c in brute([(i, r["text"]) for i, r in before.items()], 5, 80, 100)}
            assert set(after) == want and all(after[i] == before[i] for i in after)
        elif name == "secrets":
            assert set(after) == set(before)
            for i, r in after.items():
                found = secrets.scan_batch([before[i]["text"]])[0]
                assert r["text"] == secrets.redact(before[i]["text"], found) and r["n_chars"] == len(r["text"])
        else:
            labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert all(after[i] == before[i] for i in after) and 0 < len(before) - len(after) < len(before) / 2
            clean = [i for i in before if i in labels and labels[i]["quality"] == 1 and labels[i]["toxic"] == 0]
            assert sum(i in after for i in clean) >= 0.98 * len(clean)
        docs = out


def test_awkward_rows_and_empty_table(spark, tmp_path):
    for n, docs in enumerate((edge_rows.documents(spark), edge_rows.no_documents(spark))):
        at = f"{tmp_path}/{n}"
        docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        rows = corpus_pipeline.run(spark, at).collect()
        assert Counter(type(r["ids"]) for r in rows) == ({bytes: len(rows)} if n == 0 else {})
        assert (len({r["doc_id"] for r in rows}) >= 9) == (n == 0)
    assert packing.json_vocabulary().special == {"<|endoftext|>": 50256}


def test_secrets_stage_keeps_a_column_of_any_name(spark):
    rows = [(1, 'password = "abcdefghijkl1234"', 28, ["mine"], "x"), (2, "nothing here", 12, None, "y"), (3, None, None, [], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans array<string>, Spans_ string")
    out = corpus_pipeline.mask_secrets(spark, docs, "")
    assert out.columns == docs.columns
    got = {r["doc_id"]: tuple(r) for r in out.collect()}
    assert got[1][1] == secrets.MARK + '"' and got[1][2] == len(got[1][1]) and got[1][3:] == (["mine"], "x")
    assert got[2] == rows[1] and got[3] == rows[2]


def test_packing_does_not_depend_on_the_order_of_rows(spark):
    docs = edge_rows.documents(spark).select("doc_id", "text").coalesce(1)
    one = packing.pack_documents(docs.sortWithinPartitions("text"), group_bytes=10 ** 9)
    two = packing.pack_documents(docs.sortWithinPartitions("doc_id"), group_bytes=10 ** 9)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
