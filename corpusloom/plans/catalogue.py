"""The registered queries of the library's own operators, with SQL for DuckDB over the same tables.

The tables hold none of the damage that the cleaners mend, so most queries add some to every text by its id, the same
in the query and in its SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.core.rows import with_metrics
from corpusloom.functions import stats
from corpusloom.functions.pytext import token_count
from corpusloom.operators import checker, cleaners, dedup, rules, signals, typography
from corpusloom.operators.citations import TAGS, strip_citations
from corpusloom.plans import pipeline
from corpusloom.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The words of a text, and their number, in SQL.
WORDS = r"len(regexp_extract_all({}, '[^\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+'))"


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_id(key: Column, *values: str) -> Column:
    """One of the values by the key's remainder."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int") + 1)


def sql_by_id(key: str, *values: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[({key} % {len(values)}) + 1]"


def damaged(spark: SparkSession, sf_dir: str, *values: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("text", F.concat("text", by_id(F.col("doc_id"), *values)))


# -- cleaners

CITED = (" [12] tail", " [citation needed] tail", "[a] tail", " [ Note 7 ] tail", " [2024] [sic] tail", " [who?][n 3]", "")
_CITATION_SQL = r"(?i) ?\[\s*(?:" + "|".join(t.replace("?", r"\?").replace(".", r"\.") for t in TAGS) + r"|[0-9]{1,3}|[a-z]|note\s+[0-9]+|n\s+[0-9]+)\s*\]"
_CITED_SQL = f"regexp_replace(text || {sql_by_id('doc_id', *CITED)}, '{_CITATION_SQL}', '', 'g')"


@query(f"SELECT doc_id, length(c)::INT AS n_chars, md5(c) AS digest, c <> text || {sql_by_id('doc_id', *CITED)} AS changed FROM (SELECT *, {_CITED_SQL} AS c FROM documents)")
def clean_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaners.clean_citations(damaged(spark, sf_dir, *CITED), flag="changed")
    return df.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"), "changed")


COMPAT = (" ﬁne Ⅻ", " ＡＢＣ①", " x² ½", "")
COMPAT_CLEAN = (" fine XII", " ABC1", " x2 1⁄2", "")


@query(f"SELECT doc_id, md5(text || {sql_by_id('doc_id', *COMPAT_CLEAN)}) AS digest FROM documents")
def clean_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaners.clean_nfkc(damaged(spark, sf_dir, *COMPAT)).select("doc_id", F.md5("text").alias("digest"))


MOJIBAKE = (" schÃ¶n", " cafÃ© &eacute;", " â€œxâ€\x9d", " ﬂat\r\nx", "")
MOJIBAKE_CLEAN = (" schön", " café é", ' "x"', " flat\nx", "")


@query(f"SELECT doc_id, md5(text || replace({sql_by_id('doc_id', *[m.replace(chr(10), '@') for m in MOJIBAKE_CLEAN])}, '@', chr(10))) AS digest FROM documents")
def clean_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaners.clean_mojibake(damaged(spark, sf_dir, *MOJIBAKE)).select("doc_id", F.md5("text").alias("digest"))


KINDS = (" ﬂat", " x\r\ny", " \x1b[31mz", " e\u0301", "")


@query("SELECT CASE WHEN doc_id % 5 = 3 THEN 'normalize' ELSE 'apply' END AS key, count(*) AS n FROM documents WHERE doc_id % 5 < 4 GROUP BY 1")
def mojibake_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each kind of step changed a text."""
    return stats.map_totals(cleaners.clean_mojibake(damaged(spark, sf_dir, *KINDS), kinds="kinds"), "kinds")


MARKUP = (" {{lang-en|Foo}} x", " [[a b|c]] ''d''", " {{нп3|x|y}}{{cite web|url=z}}", " <ref>no</ref> {{bt-bellat||two}}", "")
MARKUP_CLEAN = (" Foo x", " c d", " y", " two", "")


@query(
    rf"""SELECT doc_id, md5(CASE doc_id % 5 WHEN 4 THEN text ELSE trim(regexp_replace(text || {sql_by_id('doc_id', *MARKUP_CLEAN)}, '\s+', ' ', 'g')) END) AS digest
    FROM documents"""
)
def clean_wiki_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaners.clean_wiki_markup(damaged(spark, sf_dir, *MARKUP)).select("doc_id", F.md5("text").alias("digest"))


PHRASES = ("У сярэдзiне", "пасьля (сьвет)", "у 1918 - 1920 гг.", "сказаў \"так\" .", "на 10 % і 5 -6", "А.С.Пушкін № 5", "ня ўсё")


SYMBOLS = (" &copy; x", " 5 -- 6", " x^2 y", " №№ 5", " so...", " a  b", "")
SYMBOLS_CLEAN = (" © x", " 5 — 6", " x² y", " № 5", " so…", " a b", "")


@query(f"SELECT doc_id, md5(text || {sql_by_id('doc_id', *SYMBOLS_CLEAN)}) AS digest FROM documents")
def clean_typography_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts by the rules for symbols, dashes and blanks; those for quotes and hard blanks, switched off, change
    some undamaged texts in ways that SQL has no short form for."""
    df = damaged(spark, sf_dir, *SYMBOLS)
    return typography.clean_typography(df, apply_nbsp=False, apply_quotes=False).select("doc_id", F.md5("text").alias("digest"))


@query()
def clean_typography(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = typography.clean_typography(damaged(spark, sf_dir, *[f" {p}" for p in PHRASES]), flag="changed")
    return df.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"), "changed")


@query()
def typography_rule_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typography.rule_fires(damaged(spark, sf_dir, *[f" {p}" for p in PHRASES]))


@query()
def cleaner_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaners in the order of the monolingual pipeline."""
    df = damaged(spark, sf_dir, *MARKUP, *CITED, *MOJIBAKE, *COMPAT)
    for clean in (cleaners.clean_wiki_markup, typography.clean_typography, cleaners.clean_citations, cleaners.clean_mojibake, cleaners.clean_nfkc):
        df = clean(df)
    return df.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


# -- pairs and their signals


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the next of its conversation."""
    turns = table(spark, sf_dir, "conversations")
    nxt = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return turns.select("conv_id", "turn", F.col("text").alias("src")).join(nxt, ["conv_id", "turn"])


_PAIRS_SQL = "(SELECT a.conv_id, a.turn, a.text AS src, b.text AS tgt FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"


def _ratio_sql(size: str, low: float, high: float, slack: int | None) -> str:
    diff = f" AND abs(t - s) > {slack}" if slack is not None else ""
    s, t = (f"greatest({size.format(c)}, 1)" for c in ("src", "tgt"))
    return f"""SELECT conv_id, turn, t / s AS len_ratio, abs(t - s)::INT AS len_diff, NOT (t / s BETWEEN {low} AND {high}){diff} AS flagged
    FROM (SELECT *, {s} AS s, {t} AS t FROM {_PAIRS_SQL})"""


def _ratio(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    df = signals.length_ratio(pairs(spark, sf_dir), **options)
    return df.select("conv_id", "turn", "metrics.len_ratio", "metrics.len_diff", (F.size("removal_reasons") > 0).alias("flagged"))


@query(_ratio_sql(WORDS, 0.5, 2.0, None))
def length_ratio_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratio(spark, sf_dir)


@query(_ratio_sql("length({})", 0.5, 2.0, None))
def length_ratio_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratio(spark, sf_dir, unit="chars")


@query(_ratio_sql(WORDS, 0.5, 2.5, 5))
def length_ratio_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratio(spark, sf_dir, max_ratio=2.5, length_slack=5)


@query(
    "WITH v AS (SELECT list_sort(list(n_chars)) AS l, count(*) AS n FROM documents) "
    + " UNION ALL ".join(f"SELECT {p}::DOUBLE AS p, l[least(floor(n * {p}::DOUBLE)::BIGINT, n - 1) + 1] AS value FROM v" for p in stats.QUANTILES)
)
def nearest_rank_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = stats.nearest_rank(table(spark, sf_dir, "documents"), "n_chars")
    return spark.createDataFrame(list(got.items()), "p double, value bigint")


# Fixed words for the stand-in predictor of languages.
MARKERS = {"eng_Latn": ("the", "of", "and", "that", "with"), "fra_Latn": ("la", "et", "les", "des", "pour"), "deu_Latn": ("der", "und", "die", "das", "mit"), "spa_Latn": ("el", "los", "que", "por", "con")}
LABELS = {"en": "eng_Latn", "fr": "fra_Latn", "de": "deu_Latn", "es": "spa_Latn"}


def _marker_sql(text: str) -> str:
    """(label, score) of a text as a struct: RE2 has no look-around, so words are taken apart first."""
    words = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')"
    counts = [f"len(list_filter({words}, lambda w: w IN ({', '.join(repr(x) for x in m)})))" for m in MARKERS.values()]
    return f"[{', '.join(counts)}]"


_LABEL_SQL = "CASE WHEN list_sum({0}) = 0 THEN 'und' ELSE ([" + ", ".join(f"'{k}'" for k in MARKERS) + "])[list_position({0}, list_max({0}))] END"
_SCORE_SQL = "CASE WHEN list_sum({0}) = 0 THEN 0.0 ELSE list_max({0}) / list_sum({0}) END"
_EXPECT_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " END"


def _expected() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("lang"))


@query(
    f"""SELECT doc_id, label, round(score, 9) AS score, NOT (label IS NOT DISTINCT FROM {_EXPECT_SQL}) OR score < 0.5 AS flagged
    FROM (SELECT doc_id, lang, {_LABEL_SQL.format('c')} AS label, {_SCORE_SQL.format('c')} AS score FROM (SELECT *, {_marker_sql('text')} AS c FROM documents))"""
)
def language_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").withColumn("original_code", _expected())
    df = signals.language(df, signals.marker_words(MARKERS))
    return df.select("doc_id", F.col("metrics.glotlid_label").alias("label"), F.round("metrics.glotlid_score", 9).alias("score"), (F.size("removal_reasons") > 0).alias("flagged"))


@query(
    f"""SELECT conv_id, turn, sl AS src_label, tl AS tgt_label, long AND (sl <> 'eng_Latn' OR ss < 0.7) AS src_wrong, long AND (tl <> 'eng_Latn' OR ts < 0.7) AS tgt_wrong
    FROM (SELECT *, {_LABEL_SQL.format('a')} AS sl, {_SCORE_SQL.format('a')} AS ss, {_LABEL_SQL.format('b')} AS tl, {_SCORE_SQL.format('b')} AS ts
          FROM (SELECT *, {_marker_sql('src')} AS a, {_marker_sql('tgt')} AS b, {WORDS.format('src')} >= 5 AND {WORDS.format('tgt')} >= 5 AS long FROM {_PAIRS_SQL}))"""
)
def pair_language_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.pair_language(pairs(spark, sf_dir), signals.marker_words(MARKERS), src_lang="eng_Latn", tgt_lang="eng_Latn", min_words=5)
    has = lambda r: F.array_contains("removal_reasons", r)
    return df.select("conv_id", "turn", F.col("metrics.src_glotlid_label").alias("src_label"), F.col("metrics.tgt_glotlid_label").alias("tgt_label"), has("src_wrong_lang").alias("src_wrong"), has("tgt_wrong_lang").alias("tgt_wrong"))


@query(f"SELECT {_LABEL_SQL.format('c')} AS value, count(*) AS n FROM (SELECT {_marker_sql('text')} AS c FROM documents) GROUP BY 1")
def language_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.language(table(spark, sf_dir, "documents"), signals.marker_words(MARKERS))
    return stats.histogram(df, "metrics.glotlid_label")


def _sizes(texts: list[str]) -> list[list[float]]:
    """A stand-in for an encoder: the length of a text."""
    return [[float(len(t))] for t in texts]


def _share(src: list[list[float]], tgt: list[list[float]]) -> list[float]:
    """A stand-in for a quality model: the shorter side by the longer one."""
    return [min(a, b) / max(a, b, 1.0) for (a,), (b,) in zip(src, tgt, strict=True)]


_SHARE_SQL = "least(length(src), length(tgt)) / greatest(length(src), length(tgt), 1)"


@query(f"SELECT conv_id, turn, round({_SHARE_SQL}, 9) AS quality FROM {_PAIRS_SQL}")
def quality_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.quality_estimate(pairs(spark, sf_dir), _sizes, _share)
    return df.select("conv_id", "turn", F.round("metrics.blaser_score", 9).alias("quality"))


@query(
    f"""WITH q AS (SELECT {_SHARE_SQL} AS q FROM {_PAIRS_SQL}), v AS (SELECT list_sort(list(q)) AS l, count(*) AS n FROM q)
    SELECT 'mean' AS statistic, round(avg(q), 9) AS value FROM q """
    + " ".join(f"UNION ALL SELECT 'p{round(p * 100)}', round(l[least(floor(n * {p}::DOUBLE)::BIGINT, n - 1) + 1], 9) FROM v" for p in stats.QUANTILES)
)
def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean and the quantiles of the quality stage."""
    got = pipeline.run(pairs(spark, sf_dir), pipeline.build([{"name": "blaser", "encode": _sizes, "score": _share}], pipeline.NEURAL))[1]["blaser"]
    rows = [("mean", got["mean"]), *got["score_quantiles"].items()]
    return spark.createDataFrame([(k, round(v, 9)) for k, v in rows], "statistic string, value double")


@query(
    """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def embedding_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(signals.cosine(F.col("embedding"), F.col("other")), 9).alias("cosine"))


# -- checker


class WordLengthChecker:
    """A stand-in for a checker process: words of 12 letters or more are misspelt, bars are typography."""

    def check(self, text: str) -> dict:
        import re

        out = []
        for m in re.finditer(r"[A-Za-z]{12,}|\|", text):
            kind = ("BAR", "typographical") if m[0] == "|" else ("LONG_WORD", "misspelling")
            out.append({"rule": {"id": kind[0], "issueType": kind[1]}, "offset": m.start(), "length": m.end() - m.start()})
        return {"matches": out}


_LONG_SQL = "len(regexp_extract_all(text, '[A-Za-z]{12,}'))"


@query(
    rf"""SELECT doc_id, a + b AS count, a AS misspelling, b AS typographical, round((a + b) / greatest({WORDS.format('text')}, 1), 9) AS density
    FROM (SELECT *, {_LONG_SQL}::INT AS a, len(regexp_extract_all(text, '\|'))::INT AS b FROM documents)"""
)
def checker_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = checker.issue_metrics(table(spark, sf_dir, "documents"), checker.checked(F.col("text"), WordLengthChecker))
    m = lambda k: F.coalesce(F.try_element_at(F.col("metrics.langtool.types"), F.lit(k)), F.lit(0)).alias(k)
    return df.select("doc_id", "metrics.langtool.count", m("misspelling"), m("typographical"), F.round("metrics.langtool.density", 9).alias("density"))


@query("SELECT lower(w) AS value, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{12,}')) AS w FROM documents) GROUP BY 1 ORDER BY n DESC, value LIMIT 500")
def checker_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").withColumn("matches", checker.checked(F.col("text"), WordLengthChecker))
    return stats.most_common(checker.flagged_words(df, F.col("matches")), "word", 500)


_ISSUE_SQL = rf"(SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{{12,}}|\|')) AS w FROM documents)"


@query(
    f"""WITH i AS {_ISSUE_SQL}, m AS (SELECT lower(w) AS w FROM i WHERE w <> '|')
    SELECT 'rows_total' AS statistic, '' AS key, count(*) AS n FROM documents
    UNION ALL SELECT 'rows_with_matches', '', count(DISTINCT doc_id) FROM i
    UNION ALL SELECT 'excluded_proper_nouns_total', '', 0
    UNION ALL SELECT 'issue_type_totals', CASE w WHEN '|' THEN 'typographical' ELSE 'misspelling' END, count(*) FROM i GROUP BY 2
    UNION ALL SELECT 'distinct_flagged_words', '', count(DISTINCT w) FROM m
    UNION ALL SELECT 'total_flagged_word_occurrences', '', count(*) FROM m
    UNION ALL (SELECT 'top_flagged_words', w, count(*) AS n FROM m GROUP BY w ORDER BY n DESC, w LIMIT 500)
    UNION ALL SELECT 'top_rule_ids', 'LONG_WORD', count(*) FROM m HAVING count(*) > 0"""
)
def checker_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checker's stage writes beside its rows, but for quantiles."""
    done = pipeline.run(table(spark, sf_dir, "documents"), pipeline.build([{"name": "languagetool", "client": WordLengthChecker}]))[1]["languagetool"]
    rows = [(s, k, n) for s, v in done.items() if s not in ("match_count_quantiles", "processing_time_s") for k, n in (v.items() if isinstance(v, dict) else [("", v)])]
    return spark.createDataFrame(rows, "statistic string, key string, n bigint")


# -- rules

RULES = [
    {"name": "long_enough", "type": "min_metric", "key": "metrics.n_words", "value": 50},
    {"name": "not_too_long", "type": "max_metric", "key": "metrics.n_words", "value": 2000},
    {"name": "no_bars", "type": "not_contains", "key": "text", "substring": "|"},
    {"name": "known_source", "type": "require_true", "key": "metrics.known"},
    {"name": "no_reasons", "type": "no_removal_reasons"},
    {"name": "not_french", "type": "reject_if_reason", "reason": "french"},
    {"name": "missing_fails", "type": "min_metric", "key": "metrics.maybe", "value": 0},
    {"name": "missing_passes", "type": "max_metric", "key": "metrics.absent", "value": 0},
]
_JUDGED_SQL = rf"""(SELECT doc_id, list_filter([
    CASE WHEN n < 50 THEN 'long_enough' END, CASE WHEN n > 2000 THEN 'not_too_long' END, CASE WHEN contains(text, '|') THEN 'no_bars' END,
    CASE WHEN source = 'src3' THEN 'known_source' END, CASE WHEN lang IN ('fr', 'es') THEN 'no_reasons' END,
    CASE WHEN lang = 'fr' THEN 'not_french' END, CASE WHEN doc_id % 5 = 0 THEN 'missing_fails' END], lambda x: x IS NOT NULL) AS f
    FROM (SELECT *, {WORDS.format('text')} AS n FROM documents))"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    df = with_metrics(df, n_words=token_count(F.col("text")), known=F.col("source") != "src3", maybe=F.when(F.col("doc_id") % 5 != 0, 1.0))
    reason = lambda lang, r: F.when(F.col("lang") == lang, F.array(F.lit(r)))
    df = df.withColumn("removal_reasons", F.coalesce(reason("fr", "french"), reason("es", "spanish"), F.array().cast("array<string>")))
    return rules.judge(df, RULES)


@query(f"SELECT doc_id, array_to_string(f, ',') AS filtered_by, len(f) = 0 AS survived FROM {_JUDGED_SQL}")
def filter_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("doc_id", F.array_join("filtered_by", ",").alias("filtered_by"), (F.size("filtered_by") == 0).alias("survived"))


@query(f"SELECT doc_id FROM {_JUDGED_SQL} WHERE len(f) = 0")
def filter_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.split(judged(spark, sf_dir))[0].select("doc_id")


@query(f"SELECT doc_id, array_to_string(f, ',') AS filtered_by FROM {_JUDGED_SQL} WHERE len(f) > 0")
def filter_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.split(judged(spark, sf_dir))[1].select("doc_id", F.array_join("filtered_by", ",").alias("filtered_by"))


_RULE_NAMES_SQL = ", ".join(f"({i}, '{r['name']}')" for i, r in enumerate(RULES))


@query(
    f"""WITH j AS {_JUDGED_SQL}, r(i, rule) AS (VALUES {_RULE_NAMES_SQL}), d AS (
      SELECT i, rule, (SELECT count(*) FROM j WHERE list_contains(f, rule)) AS failures, (SELECT count(*) FROM j WHERE f[1] = rule) AS dropped FROM r)
    SELECT rule, failures, dropped, ((SELECT count(*) FROM j) - sum(dropped) OVER (ORDER BY i))::BIGINT AS remaining_after FROM d"""
)
def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = rules.statistics(judged(spark, sf_dir), RULES)
    rows = [(f["rule"], got["per_rule_failures"][f["rule"]], f["dropped"], f["remaining_after"]) for f in got["funnel"]]
    return spark.createDataFrame(rows, "rule string, failures bigint, dropped bigint, remaining_after bigint")


@query(f'SELECT doc_id, {WORDS.format("text")}::INT AS "metrics.n_words", NULL::VARCHAR AS "metrics.absent" FROM documents')
def export_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_metrics(table(spark, sf_dir, "documents"), n_words=token_count(F.col("text")))
    return writers.project(df, ["doc_id", "metrics.n_words", "metrics.absent"])


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) || coalesce(CAST(n AS VARCHAR), '~') AS key, n > 20 AS kept
    FROM (SELECT doc_id, {WORDS.format("c")} AS n FROM (SELECT doc_id, {_CITED_SQL} AS c FROM documents))"""
)
def clean_measure_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: clean, measure, filter with attribution, in one pass without a shuffle."""
    df = damaged(spark, sf_dir, *CITED)
    df = with_metrics(df.withColumn("text", strip_citations(F.col("text"))), n_words=token_count(F.col("text")))
    df = rules.judge(df.withColumn("n", token_count(F.col("text"))), [{"name": "long", "type": "min_metric", "key": "n", "value": 21}])
    return df.select(F.concat(F.col("doc_id").cast("string"), F.coalesce(F.col("n").cast("string"), F.lit("~"))).alias("key"), (F.size("filtered_by") == 0).alias("kept"))


# -- sources

_LINE_SQL = r"""CASE turn % 4 WHEN 3 THEN 'x' || chr(9) || flat ELSE conv_id || chr(9) || flat || chr(9) || turn || chr(9) || CASE turn % 4 WHEN 2 THEN 'one two' ELSE flat END END"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("flat", F.translate("text", "\t\r\n", "   "))
    tgt = F.when(F.col("turn") % 4 == 2, F.lit("one two")).otherwise(F.col("flat"))
    line = F.when(F.col("turn") % 4 == 3, F.concat(F.lit("x\t"), "flat")).otherwise(F.concat_ws("\t", F.col("conv_id").cast("string"), "flat", F.col("turn").cast("string"), tgt))
    return turns.select(line.alias("value"))


@query(
    rf"""WITH l AS (SELECT turn, translate(text, chr(9) || chr(13) || chr(10), '   ') AS flat FROM conversations),
    s AS (SELECT CASE WHEN turn % 4 = 3 THEN 'malformed' WHEN turn % 4 = 2 OR {WORDS.format('flat')} < 3 THEN 'too_short' ELSE 'written' END AS status FROM l)
    SELECT count(*) AS read, count(*) FILTER (WHERE status = 'malformed') AS malformed, count(*) FILTER (WHERE status = 'too_short') AS too_short,
           count(*) FILTER (WHERE status = 'written') AS written FROM s"""
)
def prepare_pairs_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = readers.counters(readers.parse_pairs(_lines(spark, sf_dir)))
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} bigint" for k in got))


@query(
    rf"""WITH p AS (SELECT a.doc_id AS n, a.text AS src, b.text AS tgt FROM documents a JOIN documents b ON b.doc_id = (a.doc_id + 1) % (SELECT count(*) FROM documents))
    SELECT n, md5(src) AS src_digest, md5(tgt) AS tgt_digest, CASE WHEN {WORDS.format('src')} < 3 OR {WORDS.format('tgt')} < 3 THEN 'too_short' ELSE 'written' END AS status
    FROM (SELECT n, trim(src, ' ' || chr(9) || chr(10) || chr(13)) AS src, trim(tgt, ' ' || chr(9) || chr(10) || chr(13)) AS tgt FROM p)"""
)
def prepare_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text against the next one's, as two files of numbered lines would be put together."""
    docs = table(spark, sf_dir, "documents")
    n = docs.count()
    src = docs.select(F.col("doc_id").alias("n"), F.col("text").alias("value"))
    tgt = docs.select(F.pmod(F.col("doc_id") - 1, F.lit(n)).alias("n"), F.col("text").alias("value"))
    return readers.zip_lines(src, tgt).select("n", F.md5("src").alias("src_digest"), F.md5("tgt").alias("tgt_digest"), "status")


# -- near duplicates

#: The operator's default.
_PERM = 128


def _dedup_sql() -> str:
    a, b = dedup.permutations(_PERM)
    bands, rows = dedup.band_shape(0.8, _PERM)
    perms = ", ".join(f"min((h * {x} + {y}) % {dedup.PRIME}) AS m{i}" for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)))
    keys = " UNION ALL ".join(f"SELECT doc_id, '{k}|' || concat_ws(',', {', '.join(f'm{i}' for i in range(k * rows, (k + 1) * rows))}) AS key FROM sig" for k in range(bands))
    return rf"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents),
    g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE
      list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]) END) AS g FROM t WHERE len(w) >= 5),
    sig AS (SELECT doc_id, {perms} FROM (SELECT doc_id, ('0x' || substr(md5(g), 1, 8))::BIGINT % {dedup.PRIME} AS h FROM g) GROUP BY doc_id),
    keys AS ({keys}), links AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM keys x JOIN keys y ON x.key = y.key AND x.doc_id <> y.doc_id),
    reach AS (SELECT doc_id, doc_id AS other FROM sig UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
    low AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
    SELECT t.doc_id, coalesce(c, -(t.doc_id + 1)) AS dedup_cluster_id, coalesce(c, t.doc_id) = t.doc_id AS dedup_keeper FROM t LEFT JOIN low USING (doc_id)"""


@query(_dedup_sql())
def dedup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.clusters(table(spark, sf_dir, "documents"), "doc_id", num_perm=_PERM)


@query()
def dedup_clusters_128(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As dedup_clusters, with the defaults left to the operator."""
    return dedup.clusters(table(spark, sf_dir, "documents"), "doc_id")


@query(f"SELECT count(*) AS rows_total, count(DISTINCT dedup_cluster_id) AS clusters_total, count(*) FILTER (WHERE dedup_keeper) AS rows_kept FROM ({_dedup_sql()})")
def dedup_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup.statistics(dedup.mark_duplicates(table(spark, sf_dir, "documents"), "doc_id", num_perm=_PERM))
    return spark.createDataFrame([(got["rows_total"], got["clusters_total"], got["rows_kept"])], "rows_total bigint, clusters_total bigint, rows_kept bigint")
