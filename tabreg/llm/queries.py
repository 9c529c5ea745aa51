"""The registered queries of this subpackage and the DuckDB SQL that states the
same rows, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_trie, decontaminate, embedding_dedup, html_extract, language, licenses, line_dedup, ngram_jaccard, periodic, quality, \
    toxicity, url_filter

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# classes of documents by shingle sets: links by a join on shingles, then reachability
NGRAM_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM {{docs}}),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []::VARCHAR[]
           WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles, md5(array_to_string(list_sort(sh), chr(10))) AS k, sh FROM s),
c AS (SELECT k, min(doc_id) AS rep, any_value(sh) AS sh, any_value(n_shingles) AS n FROM n WHERE n_shingles > 0 GROUP BY k),
e AS (SELECT rep, n, unnest(sh) AS g FROM c),
pair AS (SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i
         FROM e a JOIN e b ON a.g = b.g AND a.rep <> b.rep GROUP BY 1, 2),
link AS (SELECT x, y FROM pair WHERE 100 * i >= 80 * (nx + ny - i)),
reach AS (SELECT rep AS x, rep AS y FROM c UNION SELECT l.x, r.y FROM reach r JOIN link l ON l.y = r.x),
comp AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY 1)
SELECT n.doc_id, n.n_shingles, coalesce(comp.component_id, n.doc_id) AS component_id
FROM n LEFT JOIN c ON n.k = c.k AND n.n_shingles > 0 LEFT JOIN comp ON comp.rep = c.rep"""


@query("op1_ngram_jaccard", NGRAM_SQL.format(docs="documents"))
def op1(spark, sf_dir):
    return ngram_jaccard.link_components(table(spark, sf_dir, "documents"))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), RANKS), RANKS)
    return out.select("doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_language_id")
def op9(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query("op8_license_scan")
def op8(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


# The rules of the registered query (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_FITS = "ends_with('.' || host, '.{host}') AND starts_with(path, '{path}')"
_CASES = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
URL_SQL = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path,
  CASE {' '.join(f"WHEN {_FITS.format(host=h, path=p)} THEN '{h + p}'" for h, p, _ in _CASES)} END AS rule,
  CASE {' '.join(f"WHEN {_FITS.format(host=h, path=p)} THEN '{v}'" for h, p, v in _CASES)} ELSE 'allow' END AS verdict
FROM u"""


@query("op7_url_filter", URL_SQL)
def op7(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


# exact: every pair of a label by cosine, then reachability
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT l.x, r.y FROM reach r JOIN link l ON l.y = r.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY 1),
cnt AS (SELECT x, count(*) AS n FROM link GROUP BY 1)
SELECT e.vec_id, coalesce(cnt.n, 0)::BIGINT AS n_links, coalesce(comp.c, e.vec_id) AS component_id,
       coalesce(comp.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN comp ON comp.x = e.vec_id LEFT JOIN cnt ON cnt.x = e.vec_id"""


@query("op5_embedding_dedup", EMBEDDING_SQL)
def op5(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_decontaminate")
def op4(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_html_extract")
def op3(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query("op6_quality")
def op6(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    out = periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.planted_order)
    # runs come by start, then period, so the first of equal exponents stays
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                    lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                     sha(F.array_join(lines, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "b.start", "b.length", "b.period",
                      F.expr("(1000 * b.length) div b.period").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


# crc32 of decimal digits, bit by bit; h = crc32(conv_id) % 4
_CRC = """xor(4294967295, list_reduce(
    list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT),
    lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295))"""
TRIE_SQL = rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         {{{{'role': coalesce(role, ''), 'text': coalesce(text, '')}}}} AS x
  FROM {{conversations}} WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS src, t.i, t.x FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
      UNION ALL SELECT c.conv_id, 1, t.i, t.x FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
s AS (SELECT c.conv_id, coalesce(list(r.x ORDER BY r.src, r.i) FILTER (r.i IS NOT NULL), []) AS seq
      FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY 1),
p AS (SELECT conv_id, len(seq) AS n, d, seq[1:d] AS node FROM s, unnest(range(0, len(seq) + 1)) AS u(d)),
n AS (SELECT node, d::BIGINT AS depth, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256,
             (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^ 	-
]+')) END AS saved
      FROM p GROUP BY node, d),
k AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*)::BIGINT AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(k.n_children, 0)::BIGINT AS n_children FROM n LEFT JOIN k ON k.depth = n.depth AND k.node = n.node),
b AS (SELECT m.node[1:e] AS node, e AS depth, sum(saved)::BIGINT AS saved_tokens, sum((n_children = 0)::INT)::BIGINT AS n_leaves
      FROM m, unnest(range(0, m.depth + 1)) AS u(e) GROUP BY 1, 2)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, b.n_leaves, b.saved_tokens, m.ends_sha256
FROM m JOIN b ON b.depth = m.depth AND b.node = m.node
LEFT JOIN m u ON u.depth = m.depth - 1 AND u.node = m.node[1:m.depth - 1]"""


@query("op12_conversation_trie", TRIE_SQL.format(conversations="conversations"))
def op12(spark, sf_dir):
    trie = conversation_trie.build(table(spark, sf_dir, "conversations"))
    node = conversation_trie.NODE
    return trie.nodes.join(conversation_trie.end_digests(trie), node, "left") \
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {{docs}}),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT r, doc_id, line, pos, translate(trim(line, {_SPACES}), '{UPPER}', '{LOWER}') AS key FROM l),
hot AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(hot.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON hot.key = k.key GROUP BY k.r, k.doc_id"""


@query("op13_line_dedup", LINES_SQL.format(docs="documents"))
def op13(spark, sf_dir):
    out = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
