"""URL filter by a tree of path templates.

Every host has a tree whose levels are the segments of its paths. Level by level a
segment stays a branch of its own where it holds a fair share of its node's pages;
all others (numbers, titles, dates) generalise into a wildcard that keeps a known page
kind (``*``, ``*.html``). A node so has a bounded number of branches, whatever the host's size.
Branches of one node whose shares of good labelled pages do not differ
statistically are merged and pooled. The labelled purity of a template is smoothed
from the top down: corpus, host, branch, ..., template, each pulled towards the one
above by a few pages' worth. Templates below the threshold are rejected. Rules given
by hand come first.

Native functions only. Rows meet the tree in joins whose keys may be very uneven (a host
with a third of all pages): ``join_spread`` broadcasts what the at most 1,000 most
common keys need and shuffles the rest.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.common import materialize

#: Hand rules (verdict, host/path) and the page kinds that a wildcard keeps.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
PAGE_KINDS = ("html", "htm", "php", "asp", "aspx", "jsp", "pdf", "txt", "xml")

LEVELS = 8                  # longer paths end in the branch ** there
LEAST_PAGES = 2             # a segment with fewer pages is generalised,
LEAST_SHARE = 20            # and so is one with less than 1/20 of its node's pages
SIMILAR = 2.71              # squared z score up to which two shares do not differ (10% level)
STRENGTH = 5.0              # pages' worth that a node's purity is pulled towards the one above it
THRESHOLD = 0.5             # templates below this purity are rejected
MOST_HOT = 1000             # a key is hot with at least 1/1,000 of all rows, so at most so many are


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` join ``table`` (one row per key; keys not null): the keys of ``hot`` by broadcast, all others by shuffle.

    ``hot`` holds the keys that have at least 1 / MOST_HOT of all pages, so at most MOST_HOT
    rows are broadcast, and no task of the shuffle holds more than that share for one key.
    """
    marked = rows.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    few = table.join(F.broadcast(hot.select(*keys)), keys, "left_semi")
    return (marked.where("_hot").drop("_hot").join(F.broadcast(few), keys, how)
            .unionByName(marked.where("_hot is null").drop("_hot").join(table, keys, how)))


def hottest(counts: DataFrame, count: str, total: int) -> DataFrame:
    return counts.where(F.col(count) * MOST_HOT >= total)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, rule_path = rule.split("/", 1)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, good, host, path, rule, ruled (verdict of the rule), segs (segments, at most LEVELS)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.col("good").cast("int").alias("good"), host.alias("host"), path.alias("path"))
    segs = F.filter(F.split("path", "/", -1), lambda s: s != "")
    deep = F.when(F.size("segs") > LEVELS, F.concat(F.slice("segs", 1, LEVELS - 1), F.array(F.lit("**")))).otherwise(F.col("segs"))
    found = longest_rule(F.col("host"), F.col("path"), rules)
    return (rows.withColumn("segs", segs).withColumn("_rule", found)
            .select("page_id", "good", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("ruled"), deep.alias("segs")))


def templates(rows: DataFrame) -> DataFrame:
    """``rows`` (host, segs, ...) with ``node``: the path's template, such as ``/en/*.html``; the root is empty."""
    rows = materialize(rows.withColumn("node", F.lit("")), "url-rows")
    depth, total = rows.agg(F.max(F.size("segs")), F.count(F.lit(1))).first()
    kind = F.regexp_extract("seg", r"\.(" + "|".join(PAGE_KINDS) + r")\z", 0)
    for level in range(1, (depth or 0) + 1):
        here = rows.where(F.size("segs") >= level).withColumn("seg", F.element_at("segs", level))
        kids = materialize(here.groupBy("host", "node", "seg").agg(F.count(F.lit(1)).alias("n")), "url-branches")
        nodes = kids.groupBy("host", "node").agg(F.sum("n").alias("pages"))
        branch = join_spread(kids.where(f"n >= {LEAST_PAGES}"), nodes, ["host", "node"], hottest(nodes, "pages", total), "inner")
        branch = branch.where(F.col("n") * LEAST_SHARE >= F.col("pages")).select("host", "node", "seg", F.lit(True).alias("_own"))
        named = join_spread(here, branch, ["host", "node", "seg"], hottest(kids, "n", total))
        named = named.withColumn("node", F.concat("node", F.lit("/"), F.when(F.col("_own"), F.col("seg")).otherwise(F.concat(F.lit("*"), kind))))
        rows = materialize(named.select(*rows.columns).unionByName(rows.where(F.size("segs") < level)), "url-rows")
    return rows


def template_counts(rows: DataFrame) -> DataFrame:
    """host, node, level, pages, labelled, good per template; ``good`` of ``rows`` is 1, 0 or null (no label)."""
    found = rows.groupBy("host", "node").agg(F.count(F.lit(1)).alias("pages"), F.count("good").alias("labelled"),
                                             F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    return found.withColumn("level", F.size(F.split("node", "/")) - 1)


def purities(leaves: DataFrame) -> DataFrame:
    """host, node, purity for every node of the trees over template_counts().

    A node that holds all labelled pages of the node above says nothing new and takes its purity.
    """
    depth = leaves.agg(F.max("level")).first()[0] or 0
    whole = leaves.agg(F.sum("labelled").alias("_l"), F.sum("good").alias("_g"))
    prior = whole.select(((F.coalesce("_g", F.lit(0)) + 1.0) / (F.coalesce("_l", F.lit(0)) + 2.0)).alias("_above"))
    smoothed = (F.col("good") + STRENGTH * F.col("_above")) / (F.col("labelled") + STRENGTH)
    at = leaves.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    at = at.join(F.broadcast(prior)).select("host", F.lit("").alias("node"), smoothed.alias("purity"), "labelled")
    out = at
    for level in range(1, depth + 1):
        own = (leaves.where(F.col("level") >= level).withColumn("node", F.substring_index("node", "/", level + 1))
               .groupBy("host", "node").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
               .withColumn("parent", F.substring_index("node", "/", level)))
        above = at.select("host", F.col("node").alias("parent"), F.col("purity").alias("_above"), F.col("labelled").alias("_all"))
        pooled = merged(own).join(above, ["host", "parent"])
        purity = F.when(F.col("own") == F.col("_all"), F.col("_above")).otherwise(smoothed)
        at = materialize(pooled.select("host", "node", purity.alias("purity"), F.col("own").alias("labelled")), "url-level")
        out = out.unionByName(at)
    return out.drop("labelled")


def merged(nodes: DataFrame) -> DataFrame:
    """host, parent, node, own (labelled pages) with the pooled labelled and good of the branches merged with it.

    Branches of one node (a bounded number) are taken in the order of their share of good
    pages; neighbours whose shares do not differ by a two-proportion z test are merged.
    Branches without labels have nothing to compare and stay apart from the others.
    """
    rate = (F.col("good") + 1.0) / (F.col("labelled") + 2.0)
    by_share = Window.partitionBy("host", "parent", "known").orderBy("rate", "node")
    la, ga, lb, gb = F.col("la"), F.col("ga"), F.col("labelled").cast("double"), F.col("good").cast("double")
    bad = la + lb - ga - gb
    differ = (ga * lb - gb * la) * (ga * lb - gb * la) * (la + lb) > SIMILAR * la * lb * (ga + gb) * bad
    rows = (nodes.withColumn("known", F.col("labelled") > 0).withColumn("rate", rate)
            .withColumn("la", F.lag("labelled").over(by_share).cast("double")).withColumn("ga", F.lag("good").over(by_share).cast("double")))
    rows = rows.withColumn("part", F.sum(F.when(differ, 1).otherwise(0)).over(by_share.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pool = Window.partitionBy("host", "parent", "known", "part")
    return rows.select("host", "parent", "node", F.col("labelled").alias("own"), F.sum("labelled").over(pool).alias("labelled"), F.sum("good").over(pool).alias("good"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict (allow, block), template, purity per row of ``pages`` (page_id, url, good).

    ``good`` is 1, 0 or null (no label). The longest hand rule that fits decides; without one
    the template does. A null url, or one without ``://``, has an empty host and path, whose
    template is empty; without any label every purity is 0.5, which is allowed; repeated rows
    count as pages and are judged alike; null page_ids stay null; paths of any length are read,
    those of more than LEVELS segments share a branch from there on; an empty table
    gives no rows; other columns are ignored.
    """
    rows = templates(parsed(pages, rules))
    leaves = materialize(template_counts(rows), "url-leaves")
    total = leaves.agg(F.sum("pages")).first()[0] or 0
    judged = join_spread(rows, purities(leaves), ["host", "node"], hottest(leaves, "pages", total))
    by_template = F.when(F.col("purity") < THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_template).alias("verdict"),
                         F.col("node").alias("template"), F.round("purity", 9).alias("purity"))


def document_number(path: Column) -> Column:
    """The number that a path ends in (``/en/453.html``): the page's document; null without one."""
    found = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?\z", 1)
    return F.when(found != "", found.cast("long"))


def with_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, url, good: 1 for pages of documents labelled good and not toxic, 0 for other labelled ones, else null.

    A document labelled more than once is good if all its labels say so; a null quality
    or toxic says nothing; labels without a doc_id are left out.
    """
    said = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 0).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 1)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_doc")).agg(F.min(said).alias("good"))
    rows = pages.select("page_id", "url").withColumn("_doc", document_number(host_and_path(F.col("url"))[1]))
    named = rows.where("_doc is not null")
    found = join_spread(named, known, ["_doc"], hottest(named.groupBy("_doc").count(), "count", named.count()))
    return found.select("page_id", "url", "good").unionByName(rows.where("_doc is null").select("page_id", "url", F.lit(None).cast("int").alias("good")))


def twin_sql(rules=RULES) -> str:
    """DuckDB SQL of judge(with_labels(pages, labels)): the same tree as one chain of aggregates per level."""
    fits = sorted(rules, key=lambda r: (-len(r[1]), r[1]))

    def case(value):
        whens = []
        for verdict, rule in fits:
            host, path = rule.split("/", 1)
            whens.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{value(verdict, rule)}'")
        return "CASE " + " ".join(whens) + " END"

    kinds = re.escape(".").join(["", "(" + "|".join(PAGE_KINDS) + r")\z"])
    ctes = [rf"""u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
known AS (SELECT doc_id, min(CASE WHEN quality = 0 OR toxic = 1 THEN 0 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 1 END) AS good
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
p AS (SELECT *, nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+)?/?\z', 1), '')::BIGINT AS doc,
      list_filter(string_split(path, '/'), lambda x: x <> '') AS all_segs FROM h),
r0 AS (SELECT page_id, host, path, known.good, {case(lambda v, r: r)} AS rule, {case(lambda v, r: v)} AS ruled,
       CASE WHEN len(all_segs) > {LEVELS} THEN list_concat(all_segs[1:{LEVELS - 1}], ['**']) ELSE all_segs END AS segs, '' AS node
       FROM p LEFT JOIN known ON known.doc_id = p.doc)"""]
    for n in range(1, LEVELS + 1):
        ctes.append(f"""k{n} AS (SELECT host, node, segs[{n}] AS seg, count(*) AS n FROM r{n - 1} WHERE len(segs) >= {n} GROUP BY ALL),
v{n} AS (SELECT host, node, sum(n) AS pages FROM k{n} GROUP BY ALL),
o{n} AS (SELECT k.host, k.node, k.seg FROM k{n} k JOIN v{n} v USING (host, node) WHERE k.n >= {LEAST_PAGES} AND k.n * {LEAST_SHARE} >= v.pages),
r{n} AS (SELECT r.page_id, r.host, r.path, r.good, r.rule, r.ruled, r.segs, CASE WHEN len(r.segs) < {n} THEN r.node
  ELSE r.node || '/' || coalesce(o.seg, '*' || regexp_extract(r.segs[{n}], '{kinds}', 0)) END AS node
  FROM r{n - 1} r LEFT JOIN o{n} o ON o.host = r.host AND o.node = r.node AND o.seg = r.segs[{n}])""")
    ctes.append(f"""leaves AS (SELECT host, node, count(good) AS labelled, coalesce(sum(good), 0) AS good, len(string_split(node, '/')) - 1 AS level
  FROM r{LEVELS} GROUP BY host, node),
a0 AS (SELECT host, '' AS node, (sum(good) + {STRENGTH}::DOUBLE * (SELECT (coalesce(sum(good), 0) + 1::DOUBLE) / (coalesce(sum(labelled), 0) + 2::DOUBLE) FROM leaves))
  / (sum(labelled) + {STRENGTH}::DOUBLE) AS purity, sum(labelled)::DOUBLE AS own FROM leaves GROUP BY host)""")
    for n in range(1, LEVELS + 1):
        ctes.append(f"""w{n} AS (SELECT host, array_to_string(string_split(node, '/')[1:{n}], '/') AS parent, array_to_string(string_split(node, '/')[1:{n + 1}], '/') AS node,
  sum(labelled)::DOUBLE AS lb, sum(good)::DOUBLE AS gb FROM leaves WHERE level >= {n} GROUP BY ALL),
x{n} AS (SELECT *, lb > 0 AS known, (gb + 1) / (lb + 2) AS rate, lag(lb) OVER s AS la, lag(gb) OVER s AS ga FROM w{n}
  WINDOW s AS (PARTITION BY host, parent, lb > 0 ORDER BY (gb + 1) / (lb + 2), node)),
y{n} AS (SELECT *, sum(CASE WHEN (ga * lb - gb * la) * (ga * lb - gb * la) * (la + lb) > {SIMILAR}::DOUBLE * la * lb * (ga + gb) * (la + lb - ga - gb) THEN 1 ELSE 0 END)
  OVER (PARTITION BY host, parent, known ORDER BY rate, node ROWS UNBOUNDED PRECEDING) AS part FROM x{n}),
z{n} AS (SELECT host, parent, node, lb, sum(lb) OVER q AS labelled, sum(gb) OVER q AS good FROM y{n} WINDOW q AS (PARTITION BY host, parent, known, part)),
a{n} AS (SELECT z.host, z.node, CASE WHEN z.lb = a.own THEN a.purity ELSE (z.good + {STRENGTH}::DOUBLE * a.purity) / (z.labelled + {STRENGTH}::DOUBLE) END AS purity, z.lb AS own
  FROM z{n} z JOIN a{n - 1} a ON a.host = z.host AND a.node = z.parent)""")
    every = " UNION ALL ".join(f"SELECT * FROM a{n}" for n in range(LEVELS + 1))
    return ("WITH " + ",\n".join(ctes) + f",\nb AS ({every})\nSELECT page_id, r.host, path, rule, "
            f"coalesce(ruled, CASE WHEN purity < {THRESHOLD}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, r.node AS template, round(purity, 9) AS purity "
            f"FROM r{LEVELS} r LEFT JOIN b ON b.host = r.host AND b.node = r.node")
