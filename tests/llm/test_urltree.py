"""URL filter: parsing and hand rules, generalised templates, merged branches, purity, uneven keys, awkward rows."""

from __future__ import annotations

import re

import duckdb
import pytest

from tracewise.llm import urltree


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, good int")


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path):
    best = None
    for verdict, rule in urltree.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


AWKWARD = [None, "", "no scheme/at/all", "http://", "https://Example.NET", "https://EXAMPLE.net/", "https://a.example.net/en/1",
           "https://a.example.net/en", "ftp://x.example.com/de/2?x=http://b.org/fr/", "https://notexample.com/de/1", "https://example.com/de/#/fr/",
           "https://org/fr/", "https://b.org?/fr/", "https://b.org#/fr/", "https://É.ORG/fr/é", "://net/", "a://b://c/d", "https://net:80/x", "http://x.y/" + "s/" * 40]


def test_parsing_and_rules(spark, monkeypatch):
    monkeypatch.setattr(urltree, "LEVELS", 2)
    got = urltree.judge(pages(spark, [(n, u, None) for n, u in enumerate(AWKWARD)])).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        host, path = plain_parts(AWKWARD[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), AWKWARD[r["page_id"]]


def test_variable_segments_become_wildcards(spark):
    rows = [(n, f"http://site.test/{lang}/{n}{kind}", None) for n in range(200) for lang, kind in [(("en", "fr")[n % 2], (".html", "")[n % 3 == 0])]]
    got = {r["template"] for r in urltree.judge(pages(spark, rows)).collect()}
    assert got == {"/en/*", "/en/*.html", "/fr/*", "/fr/*.html"}


def test_bad_branch_is_rejected_and_similar_ones_share_their_labels(spark):
    rows = [(n, f"http://site.test/{'bad' if n % 2 else 'good'}/{n}", (1 - n % 2) if n < 60 else None) for n in range(200)]
    rows += [(1000 + n, f"http://site.test/few/{n}", 0 if n < 2 else None) for n in range(40)]      # two bad labels alone decide nothing
    got = {r["template"]: (r["verdict"], r["purity"]) for r in urltree.judge(pages(spark, rows)).collect()}
    assert got["/bad/*"][0] == "block" and got["/good/*"][0] == "allow"
    assert got["/few/*"][0] == "block"                    # merged with /bad, whose labels it does not differ from
    alone = {r["template"]: r["verdict"] for r in urltree.judge(pages(spark, [x for x in rows if "/bad/" not in x[1]])).collect()}
    assert alone["/few/*"] == "allow"


def test_no_labels_and_no_pages(spark):
    one = [(1, "http://h.test/a/1", None)]
    assert [(r["purity"], r["verdict"]) for r in urltree.judge(pages(spark, one)).collect()] == [(0.5, "allow")]
    assert urltree.judge(pages(spark, one).limit(0)).collect() == []


def test_uneven_keys_join_once(spark):
    rows = spark.range(5000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id")
    table = spark.range(0, 5000, 2).selectExpr("id as k", "id * 10 as v")
    hot = urltree.hottest(rows.groupBy("k").count(), "count", 5000)
    assert 1 <= hot.where("k = 0").count() <= hot.count() <= urltree.MOST_HOT
    joined = urltree.join_spread(rows, table, ["k"], hot)
    plain = rows.join(table, ["k"], "left")
    assert sorted(map(tuple, joined.select("k", "id", "v").collect()), key=str) == sorted(map(tuple, plain.select("k", "id", "v").collect()), key=str)
    inner = urltree.join_spread(rows, table, ["k"], hot, "inner")
    assert inner.count() == plain.where("v is not null").count()


@pytest.mark.parametrize("many", [0, 400])
def test_equals_the_sql_twin_on_awkward_tables(spark, many, monkeypatch):
    monkeypatch.setattr(urltree, "LEVELS", 3)             # the deep path of AWKWARD ends in ** earlier
    rows = [(n % 7 if n % 5 else None, u) for n, u in enumerate(AWKWARD * 2)]
    rows += [(n, f"https://hot.test/{'abc'[n % 3]}/{n % 11}/{n * 37 % 101}" + ("", ".html", "/")[n % 3]) for n in range(many)]
    got = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "page_id long, url string, node string, good int")
    said = [(n, n % 2 if n % 4 else None, n % 9 == 0 and 1 or 0) for n in range(0, 120)] + [(5, 0, 0), (None, 1, 0)]
    labels = spark.createDataFrame(said, "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    con.register("pages_in", got.toPandas())
    con.register("labels_in", labels.toPandas())
    con.execute("CREATE VIEW pages AS SELECT page_id::BIGINT AS page_id, url FROM pages_in")
    con.execute("CREATE VIEW labels AS SELECT doc_id::BIGINT AS doc_id, quality::INT AS quality, toxic::INT AS toxic FROM labels_in")
    cur = con.execute(urltree.twin_sql())
    columns = [d[0] for d in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=str)
    mine = urltree.judge(urltree.with_labels(got, labels)).select(*columns).collect()
    assert sorted((tuple(r) for r in mine), key=str) == want
