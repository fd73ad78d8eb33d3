"""The registered queries of this subpackage, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewise.llm import bpe, cotrain, editwalk, fim, packing, periodic, quotes, rendezvous, secrets, sigtree, topk, toxicity, urltree
from tracewise.llm.common import crc32_sql, table

CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i)))"""


def op1_quotes(spark, sf_dir):
    """The conversations as a mail thread (each message quoting the two before), linked back by their quotes."""
    return quotes.format_conversations(quotes.as_mail(table(spark, sf_dir, "conversations")))


def op2_fingerprints(spark, sf_dir):
    return editwalk.compare_with_edits(table(spark, sf_dir, "documents"))


def fingerprint_links(spark, sf_dir):
    """The fingerprints of op2 banded, verified and joined: each document's component of like texts."""
    return editwalk.link_documents(table(spark, sf_dir, "documents"))


def op3_jaccard(spark, sf_dir):
    return sigtree.jaccard_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)


def op4_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_quality(spark, sf_dir):
    return cotrain.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_secrets(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_sharding(spark, sf_dir):
    return rendezvous.shard_documents(table(spark, sf_dir, "documents"))


def op10_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_fim(spark, sf_dir):
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_url_filter(spark, sf_dir):
    """Every page judged by the hand rules and the path templates, labelled by the documents that the paths name."""
    return urltree.judge(urltree.with_labels(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")))


def op13_periodic_runs(spark, sf_dir):
    """Runs of every whole text, of which a tenth is made periodic from some word on."""
    found = periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    found = found.withColumn("best", F.struct((-best["col2"]).alias("start"), best["length"].alias("length"), (-best["col3"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


BYTES = "list_transform(range(strlen(x)), lambda i: ('0x' || substr(hex(encode(x)), 2 * i + 1, 2))::BIGINT)"

OP1_SQL = """
WITH m AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
k AS (SELECT DISTINCT conv_id, turn FROM m),
i AS (SELECT conv_id, turn, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM k),
t AS (SELECT conv_id, turn, min(turn) OVER (PARTITION BY conv_id, island) AS thread FROM i)
SELECT conv_id, thread, turn, turn - thread AS depth, CASE WHEN turn > thread THEN turn - 1 END AS reply_to, role, text,
       least(turn - thread, 2) + (SELECT count(*) FROM k WHERE k.conv_id = t.conv_id AND k.turn = t.turn - 2 AND t.turn - t.thread = 0) AS n_quotes,
       least(turn - thread, 2) + (SELECT count(*) FROM k WHERE k.conv_id = t.conv_id AND k.turn = t.turn - 2 AND t.turn - t.thread = 0) AS n_linked
FROM m JOIN t USING (conv_id, turn)"""

OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
s AS (SELECT doc_id, CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
         ELSE list_distinct(list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2])) END AS g FROM w),
n AS (SELECT doc_id, len(g) AS n, g FROM s),
x AS (SELECT doc_id, n, unnest(g) AS h FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
      FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * c >= 90 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT doc_id, n.n::BIGINT AS n_shingles, least(doc_id, min(root)) AS component_id FROM n JOIN r USING (doc_id) GROUP BY doc_id, n.n"""

OP9_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, strlen(x) + 8 AS size, {crc32_sql(BYTES)} AS text_crc32
      FROM (SELECT doc_id, coalesce(text, '') AS x, t FROM documents, crc_table)),
s AS (SELECT *, list_transform(range(25), lambda i: -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '#' || i), 1, 13))::BIGINT
        + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)) AS draws FROM d),
a AS (SELECT doc_id, size, text_crc32,
        (list_position(draws[1:24], list_min(draws[1:24])) - 1)::INTEGER AS shard,
        (list_position(draws, list_min(draws)) - 1)::INTEGER AS grown_shard,
        substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32), 1, 3) AS block FROM s)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM a"""

OP10_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, x, regexp_extract_all(x, '[A-Za-z]+|[^A-Za-z]') AS u, list_transform(range(4), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS h FROM d),
c AS (SELECT doc_id, x, u, len(u)::BIGINT AS n, h, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM u),
p AS (SELECT doc_id, x, n, CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
             WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(x) AS restored_sha256
FROM p"""

QUERIES = {f.__name__: f for f in (
    op1_quotes, op2_fingerprints, fingerprint_links, op3_jaccard, op4_packing, op5_quality,
    op6_toxicity, op7_bpe, op8_secrets, op9_sharding, op10_topk, op11_fim, op12_url_filter, op13_periodic_runs)}
ORACLES = {"op1_quotes": OP1_SQL, "op3_jaccard": OP3_SQL, "op9_sharding": OP9_SQL, "op10_topk": OP10_SQL,
           "op11_fim": OP11_SQL, "op12_url_filter": urltree.twin_sql()}
