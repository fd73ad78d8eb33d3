"""Quotation linking: parsing, links against a plain version, threads, and the mail round trip."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from tracewise.llm import quotes


def test_passages_and_own_text():
    mail = "I agree.\nreally\n\nOn Monday Ann wrote:\n> first\n> line\n>> deep\n> > deep two\n\nBye"
    assert quotes.passages(mail) == [(0, "I agree.\nreally"), (1, "first\nline"), (2, "deep\ndeep two"), (0, "Bye")]
    assert quotes.own_text(mail) == "I agree.\nreally\n\nBye"
    assert quotes.passages(None) == quotes.passages("") == quotes.passages("> \n \n>>") == []
    assert quotes.passage_hash("A  b\nC") == quotes.passage_hash("a b c")


def slow(rows):
    """(conv, turn) -> (reply_to, thread, depth) by reading all messages of a conversation."""
    out = {}
    convs = {c for c, t, *_ in rows if c is not None and t is not None}
    for c in convs:
        texts = sorted({(t, x) for cc, t, _, x in rows if cc == c and t is not None}, key=lambda r: (r[0], str(r[1])))
        owned: dict = {}
        for t, x in texts:
            for level, p in quotes.passages(x):
                if level == 0:
                    owned.setdefault(quotes.passage_hash(p), set()).add(t)
        for t in sorted({t for t, _ in texts}):
            best = None
            for tt, x in texts:
                if tt != t:
                    continue
                levels: dict = {}
                for level, p in quotes.passages(x):
                    if level:
                        h = quotes.passage_hash(p)
                        levels[h] = min(level, levels.get(h, level))
                for h, level in levels.items():
                    earlier = [o for o in owned.get(h, ()) if o < t]
                    if earlier:
                        best = max(best, (-level, max(earlier))) if best else (-level, max(earlier))
            up = best[1] if best else None
            out[c, t] = (up, out[c, up][1] if up is not None else t, out[c, up][2] + 1 if up is not None else 0)
    return out


def test_links_and_threads_equal_the_plain_version(spark):
    r = random.Random(6)
    rows = []
    for c in range(12):
        said = []
        for t in range(r.randint(1, 25)):
            text = f"hello {r.randint(0, 8)}" if r.random() < 0.3 else f"conv {c} turn {t} says\nsomething {r.random()}"
            for _ in range(r.choice([0, 0, 1, 2])):
                if said:
                    level = r.choice([1, 1, 2, 3])
                    text += "\n\n" + "\n".join(">" * level + " " + x for x in r.choice(said).split("\n"))
            if r.random() < 0.1:
                text += "\n\n> nobody said this"
            said.append(quotes.own_text(text).split("\n\n")[0])
            rows.append((c, t, "user", text))
    rows += [(0, 0, "user", rows[0][3]), (99, 0, "user", None), (99, 1, "user", ""), (None, 1, "user", "x"), (98, None, "user", "> y")]
    df = spark.createDataFrame([(*x, "extra", 5) for x in rows], "conv_id long, turn long, role string, text string, own string, level int")
    got = quotes.format_conversations(df).collect()
    assert len(got) == len(rows) - 1
    want = slow(rows)
    for g in got:
        if g["conv_id"] is not None and g["turn"] is not None:
            assert (g["reply_to"], g["thread"], g["depth"]) == want[g["conv_id"], g["turn"]]
        assert ">" not in g["text"]
    assert quotes.format_conversations(df.limit(0)).count() == 0


def test_mail_round_trip(spark):
    rows = [(c, t, "user", f"message {c} {t}\nwith two lines") for c in range(5) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.format_conversations(quotes.as_mail(df)).collect()
    assert {(g["conv_id"], g["turn"], g["text"]) for g in got} == {(c, t, x) for c, t, _, x in rows}
    assert all(g["reply_to"] == (g["turn"] - 1 if g["turn"] else None) and g["depth"] == g["turn"] and g["thread"] == 0 for g in got)
    assert all(g["n_linked"] == g["n_quotes"] == min(2, g["turn"]) for g in got)


@pytest.mark.parametrize("block", [1024, 2])
def test_repeated_and_conflicting_turns_equal_the_sql_twin(spark, monkeypatch, block):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", block)
    rows = [(1, t, "user", f"turn {t} of one") for t in range(3) for _ in range(40)]                    # exact repeats
    rows += [(2, t, "user", f"turn {t} of two") for t in range(4)] + [(2, 1, "bot", "another text at turn 1")]
    rows += [(3, t, "user", f"turn {t} of three") for t in (0, 1, 2, 5, 6, 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert quotes.as_mail(df).count() == len(set(rows))
    got = quotes.format_conversations(quotes.as_mail(df))
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    from tracewise.llm.queries import OP1_SQL
    cur = con.execute(OP1_SQL)
    want = Counter(cur.fetchall())
    assert Counter(map(tuple, got.select(*[d[0] for d in cur.description]).collect())) == want


def test_a_passage_in_every_turn_is_found_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 4)
    rows = [(1, t, "user", "same words" if t % 3 == 0 else f"own {t}\n\n> same words") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["reply_to"] for r in quotes.format_conversations(df).collect()}
    assert got == {t: (None if t % 3 == 0 else t - t % 3) for t in range(40)}
