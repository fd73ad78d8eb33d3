"""Secret scan: base rules against a plain reading of the contract, linking rules, redaction."""

from __future__ import annotations

import hashlib
import random
import re

from tests.llm import edge_rows
from tracewise.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def random_text(seed):
    r = random.Random(seed)
    bits = ["password", "API_KEY", "apikey ", "ſecret", "toKen", "toKen", "=", ": ", "\"", "'", "AKIA", "0123456789abcdef", "deadbeef", "XYZ0", "é🙂",
            "\n", " ", "abcABC123+/=", "http://h.example/p", "10.2.3.4:5432", "user=bob", "Zx9Qw8Er7Ty6Ui5Op4As3Df2", "a", "secret"]
    return "".join(r.choice(bits) for _ in range(r.randint(0, 60)))


def test_base_spans_follow_the_contract(spark):
    texts = [random_text(i) for i in range(400)] + ["token=" + "a" * 100000, "AKIAKIA" + "A" * 13, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.report(df).collect():
        want = base(texts[r["doc_id"]] or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        kept = [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(kept) == shown


def kinds(text, scope=300):
    return [secrets.KINDS[k] for k, _, _ in secrets.scan_batch([text], scope)[0]]


def test_weak_parts_need_their_complement():
    weak, access = "Zx9Qw8Er7Ty6Ui5Op4As3Df2", "AKIAABCDEFGHIJKLMN"
    assert kinds(weak) == [] and kinds("see http://h.example/p") == [] and kinds("user=bob at 10.0.0.1") == []
    assert kinds(f"{access} and {weak}") == ["access", "weak_secret"]
    assert kinds(f"{access} at http://h.example/p with {weak}") == ["access", "endpoint", "weak_secret"]
    assert kinds(f"user=bob {weak}") == ["user", "weak_secret"]
    assert kinds(f"{access} {'x ' * 200}{weak}") == ["access"]
    assert kinds(f"post to https://h.example/p\nwith {weak}") == ["endpoint", "weak_secret"]
    assert kinds(f"https://h.example/p {'x ' * 80}{weak}") == []                   # an endpoint complements only nearby
    url_safe = "eyJhbGciOiJIUzI1NiIs-InR5cCI6IkpXVCJ9_Zx9Qw8Er7Ty6Ui5Op"
    assert kinds(f"user=bob {url_safe}") == ["user", "weak_secret"]
    assert kinds("user=bob Read-The-New-2024-Guide-To-Our-Big-City-Now") == []      # hyphenated words
    assert secrets.scan_batch([access, weak]) == [[(1, 0, 18)], []]


def test_interval_join_equals_all_pairs():
    import numpy as np
    r = random.Random(4)
    for _ in range(200):
        a = sorted((s, s + r.randint(1, 20)) for s in (r.randint(0, 300) for _ in range(r.randint(0, 12))))
        b = [(s, s + r.randint(1, 20)) for s in (r.randint(0, 300) for _ in range(r.randint(0, 12)))]
        cols = [np.array([x[i] for x in y], np.int64) for y in (a, b) for i in (0, 1)]
        want = [any(0 <= s - d <= 15 or 0 <= c - e <= 15 for c, d in b) for s, e in a]
        assert secrets.near(*cols, 15).tolist() == want
        assert secrets.overlaps(*cols).tolist() == [any(c < e and d > s for c, d in b) for s, e in a]


def test_redaction_and_awkward_rows(spark):
    docs = edge_rows.documents(spark)
    got = {(r["doc_id"], r["n_chars"]): r for r in secrets.scan(docs, mark="[X]").collect()}
    assert len(got) == docs.dropDuplicates(["doc_id", "n_chars"]).count()
    assert got[3, 0]["text"] is None and got[4, 0]["text"] == "" and got[4, 0]["spans"] == []
    cut = next(r for k, r in got.items() if k[0] == 11)
    assert cut["text"].strip() == "[X]\" and [X]" and secrets.scan_batch([cut["text"]]) == [[]]
    assert secrets.redact("abcdef", [(0, 1, 3), (2, 2, 4)], "-") == "a-ef"
    assert secrets.scan(edge_rows.no_documents(spark)).count() == 0
