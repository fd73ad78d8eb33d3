"""Fill-in-middle: every form against a plain construction, exact restoration, awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

from tests.llm.edge_rows import documents, no_documents
from tracewise.llm import fim

PARTS = ["a", "B", "cd", "é", "🙂", " ", "\n", "<", "S", ">", "<P", "1", "ß", "[", "\x00"]


def expected(text, doc_id):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_forms_and_round_trip():
    r, seen = random.Random(3), set()
    for _ in range(3000):
        text, doc_id = "".join(r.choice(PARTS) for _ in range(r.randint(0, 30))), r.randint(-5, 10 ** 6)
        n, form, prefix, middle, output = fim.transform_text(text.encode(), doc_id)
        assert (n, form, prefix, middle, output.decode()) == expected(text, doc_id)
        assert fim.restore_text(output, form) == text.encode()
        seen.add(form)
    assert seen == {"plain", "psm", "spm"}


def test_rotation_of_large_blocks():
    whole = bytes(random.Random(1).randbytes(500_000))
    buffer = bytearray(whole)
    fim.rotate(buffer, 5, 300_001, 499_990)
    assert bytes(buffer) == whole[:5] + whole[300_001:499_990] + whole[5:300_001] + whole[499_990:]


def test_awkward_rows(spark):
    docs = documents(spark, "then <S> stays plain")
    rows = fim.restore(fim.transform(docs)).collect()
    assert len(rows) == docs.count()
    texts = sorted((t or "") for _, t in docs.select("doc_id", "text").collect())
    assert sorted(r["restored"] for r in rows) == texts
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == expected(r["restored"], r["doc_id"])
    assert fim.restore(fim.transform(no_documents(spark))).collect() == []
