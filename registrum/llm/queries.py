"""The registered queries of this subpackage and their SQL.

Each query applies its operator, with production parameters, to its whole table and
derives the result's columns from the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import classifier, embeddings, html, lm, minhash, mixing, packing, pii, rules, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.packed(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2).withColumnRenamed("id", "doc_id")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    # sums of logarithms differ in their last digits with the order of the terms
    return out.withColumn("score", F.floor(F.col("score") * 1e7 + 0.5) / 1e7)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selection(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judged(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), *rules.COUNTS, "base_failed", "kept")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(_table(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(_table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_embedding_near_dedup, op3_minhash_near_dedup, op4_lm_scoring, op5_mixing, op6_quality_classifier, op7_quality_rules, op8_html_extraction, op9_pii, op10_url_filters)}


_OP10 = r"""
WITH RECURSIVE page AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rule, h, p) AS (VALUES
  ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('block', 'net/de/', 'net', '/de/'),
  ('allow', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
tags AS (SELECT url AS a, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM page),
named AS (SELECT a, CASE
    WHEN regexp_matches(tag, '(?is)^<link\b[^>]*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?\s*refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*((?:&amp;|[^"''\s>;])+)', 1) END AS b FROM tags),
links AS (SELECT a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(a, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(a, '(?s)^(.*?://[^/?#]*)', 1) || t
    WHEN starts_with(t, '?') THEN regexp_extract(a, '(?s)^(.*?://[^?#]*)', 1) || t
    WHEN regexp_matches(t, '^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
    WHEN regexp_matches(a, '(?s)^.*?://[^/?#]*/') THEN regexp_extract(a, '(?s)^(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)', 1) || t
    ELSE regexp_extract(a, '(?s)^(.*?://[^/?#]*)', 1) || '/' || t END AS b
  FROM (SELECT a, replace(b, '&amp;', '&') AS t FROM named WHERE b <> '' AND a LIKE '%://%')),
node AS (SELECT DISTINCT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS n
  FROM (SELECT a AS url FROM links UNION SELECT b FROM links) WHERE url LIKE '%://%'),
edge AS (SELECT DISTINCT x.n AS a, y.n AS b FROM links JOIN node x ON x.url = a JOIN node y ON y.url = b),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT a AS n, a AS m FROM both_ways UNION SELECT r.n, e.b FROM reach r JOIN both_ways e ON r.m = e.a),
fit AS (SELECT m, arg_max(verdict, length(rule)) AS v FROM (SELECT DISTINCT m FROM reach) JOIN rules
  ON (regexp_extract(m, '^[^/?#]*') = h OR ends_with(regexp_extract(m, '^[^/?#]*'), '.' || h)) AND starts_with(regexp_extract(m, '^[^/?#]*([^?#]*)', 1), p) GROUP BY m),
blocked AS (SELECT DISTINCT n FROM reach JOIN fit USING (m) WHERE v = 'block'),
best AS (SELECT page_id, url, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM page LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN
    lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) IN (SELECT n FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""

_OP5 = r"""
WITH doc AS (
  SELECT doc_id, CASE WHEN coalesce(source, '') = 'src0' THEN 'hub' ELSE 'tail' END AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS available FROM doc GROUP BY ALL),
dom0 AS (SELECT 0 AS one, domain, domain AS name, CAST(sum(available * 3) AS BIGINT) AS c, CASE domain WHEN 'hub' THEN 2 WHEN 'tail' THEN 3 ELSE 1 END AS w,
    (SELECT CAST(sum(available) AS BIGINT) FROM leaf) AS b FROM leaf GROUP BY domain),
dom1 AS (SELECT *, coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w0
  FROM dom0 WINDOW o AS (PARTITION BY one ORDER BY c::DOUBLE / w, name)),
dom2 AS (SELECT *, min((b - c0) * w >= c * w0) OVER (PARTITION BY one ORDER BY c::DOUBLE / w, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fits FROM dom1),
dom AS (SELECT domain, CAST(CASE WHEN fits THEN c ELSE (b - coalesce(sum(c) FILTER (WHERE fits) OVER (PARTITION BY one), 0)) * w // sum(w) FILTER (WHERE NOT fits) OVER (PARTITION BY one) END AS BIGINT) AS b FROM dom2),
lang0 AS (SELECT domain, lang, lang AS name, CAST(sum(available * 3) AS BIGINT) AS c, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w, any_value(dom.b) AS b FROM leaf JOIN dom USING (domain) GROUP BY domain, lang),
lang1 AS (SELECT *, coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w0
  FROM lang0 WINDOW o AS (PARTITION BY domain ORDER BY c::DOUBLE / w, name)),
lang2 AS (SELECT *, min((b - c0) * w >= c * w0) OVER (PARTITION BY domain ORDER BY c::DOUBLE / w, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fits FROM lang1),
lang AS (SELECT domain, lang, CAST(CASE WHEN fits THEN c ELSE (b - coalesce(sum(c) FILTER (WHERE fits) OVER (PARTITION BY domain), 0)) * w // sum(w) FILTER (WHERE NOT fits) OVER (PARTITION BY domain) END AS BIGINT) AS b FROM lang2),
src0 AS (SELECT domain, lang, source, source AS name, available, available * 3 AS c, 1 AS w, lang.b FROM leaf JOIN lang USING (domain, lang)),
src1 AS (SELECT *, coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w0
  FROM src0 WINDOW o AS (PARTITION BY domain, lang ORDER BY c::DOUBLE / w, name)),
src2 AS (SELECT *, min((b - c0) * w >= c * w0) OVER (PARTITION BY domain, lang ORDER BY c::DOUBLE / w, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fits FROM src1),
plan AS (SELECT domain, lang, source, available, CAST(CASE WHEN fits THEN c ELSE (b - coalesce(sum(c) FILTER (WHERE fits) OVER (PARTITION BY domain, lang), 0)) * w // sum(w) FILTER (WHERE NOT fits) OVER (PARTITION BY domain, lang) END AS BIGINT) AS want FROM src2),
drawn AS (SELECT doc.*, available, want, unnest(range((want - 1) // available + 1)) AS epoch FROM doc JOIN plan USING (domain, lang, source) WHERE want > 0),
placed AS (SELECT *, CAST(coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5('mix-1:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM drawn)
SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, start, tokens, CAST(least(tokens, want - epoch * available - start) AS BIGINT) AS take
FROM placed WHERE least(tokens, want - epoch * available - start) > 0
"""


_OP2 = """
WITH v AS (SELECT vec_id, CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (WITH RECURSIVE r AS (SELECT a, b FROM link UNION SELECT r.a, link.b FROM r JOIN link ON r.b = link.a) SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM v LEFT JOIN reach ON a = vec_id
"""

_OP3 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
every AS (SELECT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS s FROM w),
sh AS (SELECT DISTINCT doc_id, s FROM every),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
ids AS (SELECT doc_id, list(s ORDER BY s) AS l FROM sh GROUP BY doc_id),
class AS (SELECT l, min(doc_id) AS rep FROM ids GROUP BY l),
small AS (SELECT sh.doc_id, sh.s FROM sh JOIN class ON rep = doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM small a JOIN small b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
one AS (SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * both_.n >= 80 * (x.n + y.n - both_.n)),
link AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
reach AS (WITH RECURSIVE r AS (SELECT a, b FROM link UNION SELECT r.a, link.b FROM r JOIN link ON r.b = link.a) SELECT a, min(b) AS least FROM r GROUP BY a),
of AS (SELECT ids.doc_id, least(rep, coalesce(least, rep)) AS c FROM ids JOIN class USING (l) LEFT JOIN reach ON a = rep)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, documents.doc_id) AS component_id, documents.doc_id = coalesce(c, documents.doc_id) AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN of USING (doc_id)
"""

_OP4 = r"""
WITH good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING bool_and(coalesce(quality = 1 AND toxic = 0, false))),
doc AS (SELECT row_number() OVER () AS r, doc_id, (doc_id IN (SELECT doc_id FROM good))::INT AS t,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
tok AS (SELECT r, t, unnest(ws) AS w, unnest(list_concat(['^ '], ws[:-2])) AS u FROM doc WHERE len(ws) > 0),
uni AS (SELECT w, count(*)::DOUBLE AS n0, sum(t)::DOUBLE AS n1 FROM tok GROUP BY w),
con AS (SELECT u, count(*)::DOUBLE AS n0, sum(t)::DOUBLE AS n1 FROM tok GROUP BY u),
bi AS (SELECT u, w, count(*)::DOUBLE AS n0, sum(t)::DOUBLE AS n1 FROM tok GROUP BY ALL),
total AS (SELECT sum(n0) AS n0, sum(n1) AS n1, count(*) AS v FROM uni),
gain AS (SELECT bi.u, bi.w, ln((bi.n1 + 100 * (uni.n1 + 1) / (total.n1 + v + 1)) / (con.n1 + 100)) - ln((bi.n0 + 100 * (uni.n0 + 1) / (total.n0 + v + 1)) / (con.n0 + 100)) AS g
  FROM bi JOIN uni USING (w) JOIN con USING (u), total),
score AS (SELECT r, count(*) AS n, sum(g) / count(*) AS s FROM tok JOIN gain USING (u, w) GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_tokens, coalesce(floor(s * 1e7 + 0.5) / 1e7, 0.0) AS score FROM doc LEFT JOIN score USING (r)
"""

_OP7 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, ws, unnest(ws) AS word FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM doc)),
words AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY r),
win AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS g
  FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM doc) WHERE len(ws) > 2),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM doc) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (SELECT r, doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM doc LEFT JOIN words USING (r) LEFT JOIN rep USING (r) LEFT JOIN line USING (r)),
flag AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
rule AS (SELECT *, base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines AS failed FROM flag),
host AS (SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k FROM rule GROUP BY source),
mean AS (SELECT sum(k) / sum(n) AS m, count(*) / sum(n) AS share FROM host),
var AS (SELECT any_value(m) AS m, any_value(m * (1 - m)) AS u, sum(n * pow(k / n - m, 2)) / sum(n) AS v, any_value(share) AS share FROM host, mean),
prior AS (SELECT m, CASE WHEN v - u * share > 0 THEN greatest(1.0, least(1e6, (u - v) / (v - u * share))) ELSE 1e6 END AS s FROM var),
rate AS (SELECT source, (k + m * s) / (n + s) AS rate FROM host, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT failed AND rate <= 0.5 AS kept
FROM rule JOIN rate ON rule.source IS NOT DISTINCT FROM rate.source
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_near_dedup": _OP2, "op3_minhash_near_dedup": _OP3, "op4_lm_scoring": _OP4, "op5_mixing": _OP5, "op7_quality_rules": _OP7, "op10_url_filters": _OP10}
