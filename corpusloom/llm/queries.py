"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, jaccard_join, lang_id, mixing, packing, ppm, prefix_counts, quality, secrets, url_filter

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES).drop("matched")


OP1_SQL = """
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), rules(rule_host, rule_path, said) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), numbered AS (SELECT *, row_number() OVER () AS n FROM parts),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(said, length(rule_host || rule_path)) AS said
  FROM numbered JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM numbered LEFT JOIN best USING (n)
"""


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"), n=3, percent=90)


OP2_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g
  FROM split
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM low LEFT JOIN sizes USING (doc_id) LEFT JOIN degree USING (doc_id)
"""


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), budget_share=1.0, entropy_share=0.5, max_repeats=4.0, seed=7)


OP3_SQL = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id AS id, source, md5(text) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents
), rows_ AS (SELECT id, source, digest, n, count(*)::BIGINT AS r FROM toks GROUP BY ALL),
src AS (SELECT source, sum(n * r)::BIGINT AS tokens, sum(r)::BIGINT AS docs FROM rows_ GROUP BY source HAVING sum(n * r) > 0),
tot AS (SELECT coalesce(sum(tokens), 0)::BIGINT AS t, list(tokens::DOUBLE) AS each FROM src),
nat AS (
  SELECT t, list_transform(each, lambda x: x / t) AS p,
         -list_sum(list_transform(each, lambda x: x / t * ln(x / t))) AS h1, ln(len(each)) AS h0
  FROM tot
), search(i, low, high, rlow, rhigh, t, p, want) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, t, p, h1 + 0.5 * (h0 - h1) FROM nat
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END,
         CASE WHEN many THEN rmid ELSE rlow END, CASE WHEN many THEN rhigh ELSE rmid END, t, p, want
  FROM (
    SELECT *, (low + high) / 2 AS mid, (rlow + rhigh) / 2 AS rmid,
           ln(list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))))
             - (low + high) / 2 * list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2) * ln(x)))
               / list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) >= want AS ok,
           list_max(list_transform(p, lambda x: pow(x, (rlow + rhigh) / 2 - 1)))
             / list_sum(list_transform(p, lambda x: pow(x, (rlow + rhigh) / 2))) > 4.0 AS many
    FROM search WHERE i < 45
  )
), exponent AS (
  SELECT CASE WHEN list_max(list_transform(p, lambda x: 1 / x)) / len(p) > 4.0 THEN greatest(low, rlow) ELSE low END AS a, p FROM search WHERE i = 45
), targets AS (
  SELECT source AS of_, tokens, ceil(docs / 2000.0)::BIGINT AS blocks,
         (round(pow(tokens::DOUBLE / t, a) / list_sum(list_transform(p, lambda x: pow(x, a))) * 1000000000000)::HUGEINT * t // 1000000000000)::BIGINT AS target
  FROM src, tot, exponent
), keyed AS (
  SELECT *, md5(concat_ws('|', '7', coalesce(id::VARCHAR, '~'), coalesce(digest, '~'))) AS key
  FROM rows_ LEFT JOIN targets ON source IS NOT DISTINCT FROM of_
), live AS (SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % blocks AS block FROM keyed WHERE n > 0),
per AS (
  SELECT of_, block, coalesce(sum(t) OVER (PARTITION BY of_ ORDER BY md5(concat_ws('|', '7', coalesce(of_, '~'), block::VARCHAR)), block
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
  FROM (SELECT of_, block, sum(n * r) AS t FROM live GROUP BY of_, block)
), placed AS (
  SELECT live.*, before_ + coalesce(sum(n * r) OVER (PARTITION BY live.of_, live.block ORDER BY key, id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS first_
  FROM live JOIN per ON live.of_ IS NOT DISTINCT FROM per.of_ AND live.block = per.block
), copies AS (SELECT *, unnest(range(r)) AS copy FROM placed),
used AS (
  SELECT id, source, n, block, (first_ + copy * n)::BIGINT AS pos,
         target // tokens + CASE WHEN first_ + copy * n < target % tokens THEN 1 ELSE 0 END AS times
  FROM copies
)
SELECT id AS doc_id, source, n AS n_tokens, unnest(range(times))::BIGINT AS epoch, block::BIGINT AS block, pos AS position FROM used
UNION ALL
SELECT id, source, n, 0, 0, 0 FROM (SELECT *, unnest(range(r)) FROM rows_ WHERE n = 0)
"""


def _fold(k: int):
    """crc32 of the id as text, modulo k; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % k


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lang_id.identify(docs, _fold(3) != 1, more={"held_out": _fold(3) == 1})


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(_table(spark, sf_dir, "documents"), held_out=_fold(5) == 1)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_model")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality.quality_cascade(_table(spark, sf_dir, "documents"), measures=names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *names, failed.alias("base_failed"), "kept")


OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT n, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
counts AS (
  SELECT n, doc_id, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper
  FROM split
), words AS (SELECT n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
windows AS (
  SELECT n, pos, word AS a, lead(word) OVER s AS b, lead(word, 2) OVER s AS c FROM words WINDOW s AS (PARTITION BY n ORDER BY pos)
), twice AS (SELECT *, count(*) OVER (PARTITION BY n, a, b, c) > 1 AND c IS NOT NULL AS rep FROM windows),
cover AS (
  SELECT n, count(*) FILTER (WHERE rep OR before1 OR before2) AS n_repeat_words
  FROM (SELECT n, rep, coalesce(lag(rep) OVER s, false) AS before1, coalesce(lag(rep, 2) OVER s, false) AS before2
        FROM twice WINDOW s AS (PARTITION BY n ORDER BY pos))
  GROUP BY n
), measured AS (
  SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_upper
  FROM counts LEFT JOIN cover USING (n)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR word_chars > 18 * n_words OR 2 * word_chars < 3 * n_words OR 10 * n_upper > 8 * n_words) AS kept
FROM measured
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), WORD_VOCABULARY, size=2048, end_id=0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count_tokens(_table(spark, sf_dir, "documents"), WORD_VOCABULARY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_mix_sources": op3_mix_sources,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_counts": op10_token_counts,
}
ORACLE_SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op2_ngram_jaccard_join": OP2_SQL, "op3_mix_sources": OP3_SQL, "op8_quality_rules": OP8_SQL}
