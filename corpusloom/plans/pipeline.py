"""Pipelines of stages out of settings: DataFrame in, DataFrame out, statistics in the same pass."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut
from corpusloom.functions import stats
from corpusloom.operators import checker, cleaners, signals, typography


@dataclass
class Stage:
    """apply(df, flag) -> df; flag names a column that says whether the row changed, for stages that clean.

    Columns named flag_... are for statistics only. counts are aggregates over the rows; quantiles and labels name columns;
    totals name maps that are summed by key; words is how many flagged words and rules are listed, if any.
    """

    name: str
    apply: Callable[[DataFrame, str], DataFrame]
    counts: dict[str, Callable[[str], Column]] = field(default_factory=dict)
    quantiles: dict[str, str] = field(default_factory=dict)
    labels: dict[str, str] = field(default_factory=dict)
    totals: dict[str, Callable[[str], str]] = field(default_factory=dict)
    words: int = 0


def _cleaner(base: str, fn: Callable, total: tuple[str, str] | None = None) -> Callable[..., Stage]:
    """total is (name in the statistics, the cleaner's option for a map column)."""

    def make(input_field: str = "text", output_field: str | None = None, **options) -> Stage:
        name = base if input_field == "text" else f"{base}_{input_field}"
        more = (lambda flag: {total[1]: f"{flag}_map"}) if total else (lambda flag: {})
        totals = {total[0]: lambda flag: f"{flag}_map"} if total else {}
        return Stage(name, lambda df, flag: fn(df, input_field, output_field, flag=flag, **more(flag), **options), {"rows_changed": lambda flag: F.count_if(F.col(flag))}, totals=totals)

    return make


def _flagged(reason: str) -> Callable[[str], Column]:
    return lambda _: F.count_if(F.array_contains("removal_reasons", reason))


def _length_ratio(**options) -> Stage:
    return Stage("length_ratio", lambda df, _: signals.length_ratio(df, **options), {"rows_flagged": _flagged("len_ratio_out_of_bounds")}, {"len_ratio_quantiles": "metrics.len_ratio", "len_diff_quantiles": "metrics.len_diff"})


def _predictor(options: dict) -> signals.Predictor:
    if predict := options.pop("predict", None):
        options.pop("model_path", None)
        return predict
    return signals.fasttext_predictor(options.pop("model_path"))


def _language(**options) -> Stage:
    predict = _predictor(options)
    field_, prefix = options.get("input_field", "text"), options.get("metric_prefix", "glotlid")
    name = "glotlid" if field_ == "text" else f"glotlid_{field_}"
    return Stage(name, lambda df, _: signals.language(df, predict, **options), {"rows_flagged": _flagged(options.get("removal_reason", "wrong_lang"))}, {"score_quantiles": f"metrics.{prefix}_score"})


def _pair_language(**options) -> Stage:
    predict = _predictor(options)
    both = lambda _: F.count_if(F.array_contains("removal_reasons", "src_wrong_lang") & F.array_contains("removal_reasons", "tgt_wrong_lang"))
    counts = {"src_flagged": _flagged("src_wrong_lang"), "tgt_flagged": _flagged("tgt_wrong_lang"), "both_flagged": both}
    return Stage("bi_glotlid", lambda df, _: signals.pair_language(df, predict, **options), counts, {}, {"src_label_totals": "metrics.src_glotlid_label", "tgt_label_totals": "metrics.tgt_glotlid_label"})


def _checker(**options) -> Stage:
    command, client = options.pop("command", None), options.pop("client", None)
    if command is None and client is None:
        raise ValueError("the checker needs a command or a client")
    if options.pop("workers", 1) < 1:
        raise ValueError("workers must be at least 1")
    start = {k: options.pop(k) for k in ("language", "startup_timeout", "no_suggestions") if k in options}
    track, top = options.pop("track_word_freq", True), options.pop("word_freq_top", 500)
    kinds = tuple(options.pop("word_freq_issue_types", ("misspelling",)))
    make = client or (lambda: checker.LineChecker(command, **start))
    field_, prefix = options.get("input_field", "text"), options.get("metric_prefix", "langtool")
    name = "languagetool" if field_ == "text" else f"languagetool_{field_}"
    return Stage(
        name,
        lambda df, flag: checker.issue_metrics(df, checker.checked(F.col(f"`{field_}`"), make), words=f"{flag}_words" if track else None, word_types=kinds, **options),
        {
            "rows_with_matches": lambda _: F.count_if(F.col(f"metrics.{prefix}.count") > 0),
            "excluded_proper_nouns_total": lambda _: F.coalesce(F.sum(f"metrics.{prefix}.excluded_proper_nouns"), F.lit(0)),
        },
        {"match_count_quantiles": f"metrics.{prefix}.count"},
        totals={"issue_type_totals": lambda _: f"metrics.{prefix}.types"},
        words=top if track else 0,
    )


def _quality(**options) -> Stage:
    key = options.get("metric_key", "blaser_score")
    return Stage("blaser" if key == "blaser_score" else f"blaser_{key}", lambda df, _: signals.quality_estimate(df, **options), {"mean": lambda _: F.avg(f"metrics.{key}")}, {"score_quantiles": f"metrics.{key}"})


def _embedding_cosine(**options) -> Stage:
    if "encode" not in options:
        raise NotImplementedError("sonar_cosine needs an encoder: give encode=")
    return Stage("sonar_cosine", lambda df, _: signals.embedding_cosine(df, **options))


MONO = {
    "wiki_markup": _cleaner("wiki_markup", cleaners.clean_wiki_markup),
    "wikificator": _cleaner("wikificator", typography.clean_typography, ("rule_fire_counts", "fires")),
    "citations": _cleaner("citations", cleaners.clean_citations),
    "ftfy": _cleaner("ftfy", cleaners.clean_mojibake, ("explanation_kinds", "kinds")),
    "nfkc": _cleaner("nfkc", cleaners.clean_nfkc),
    "glotlid": _language,
    "languagetool": _checker,
}
PARALLEL = MONO | {"length_ratio": _length_ratio, "bi_glotlid": _pair_language}
NEURAL = {"blaser": _quality, "sonar_cosine": _embedding_cosine}


def build(stages: list[dict], registry: dict[str, Callable[..., Stage]] = PARALLEL) -> list[Stage]:
    out = []
    for spec in stages:
        options = dict(spec)
        name = options.pop("name")
        if name not in registry:
            raise ValueError(f"Unknown stage: {name}. Available: {sorted(registry)}")
        out.append(registry[name](**options))
    return out


def apply(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """All stages as one lazy plan; rows and their order of columns stay."""
    for i, stage in enumerate(stages):
        df = stage.apply(df, f"_changed{i}")
    return _without_notes(df, stages)


def _without_notes(df: DataFrame, stages: list[Stage]) -> DataFrame:
    return df.drop(*[f"_changed{i}{end}" for i in range(len(stages)) for end in ("", "_map", "_words")])


def flagged_statistics(df: DataFrame, column: str, top: int) -> dict:
    """Of an array column of (word, rule_id): distinct words, all of them, the most frequent words and rules."""
    rows = df.select(F.explode(column).alias("m")).select("m.*")
    n = stats.histogram(rows, "word").agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    listed = {name: {r.value: r.n for r in stats.most_common(rows, c, top).collect()} for name, c in (("top_flagged_words", "word"), ("top_rule_ids", "rule_id"))}
    return {"distinct_flagged_words": n.distinct, "total_flagged_word_occurrences": n.total, **listed}


def run(df: DataFrame, stages: list[Stage]) -> tuple[DataFrame, dict[str, dict]]:
    """(result, statistics by stage name). The result is written once to the shared folder; counts come with that pass."""
    began = time.perf_counter()
    for i, stage in enumerate(stages):
        df = stage.apply(df, f"_changed{i}")
    counts = {(i, n): c(f"_changed{i}") for i, s in enumerate(stages) for n, c in s.counts.items()}
    seen = Observation()
    df = df.observe(seen, F.count("*").alias("rows_total"), *[c.alias(f"{i}|{n}") for (i, n), c in counts.items()])
    done = cut(df.drop(*[f"_changed{i}" for i in range(len(stages))]), "pipeline")  # with what totals and words need
    got = seen.get
    out = {}
    for i, s in enumerate(stages):
        one = {"rows_total": got["rows_total"], **{n: v for n in s.counts if (v := got[f"{i}|{n}"]) is not None}}
        for name, column in s.quantiles.items():
            if q := stats.nearest_rank(done, column):
                one[name] = {f"p{round(p * 100)}": v for p, v in q.items()}
        for name, column in s.labels.items():
            one[name] = {r.value: r.n for r in stats.histogram(done, column).collect()}
        for name, column in s.totals.items():
            one[name] = {r.key: r.n for r in stats.map_totals(done, column(f"_changed{i}")).collect()}
        if s.words:
            one |= flagged_statistics(done, f"_changed{i}_words", s.words)
        out[s.name] = one
    for one in out.values():  # one pass makes all stages, so there is one time for all
        one["processing_time_s"] = round(time.perf_counter() - began, 3)
    return _without_notes(done, stages), out


def write_statistics(statistics: dict[str, dict], folder: str, prefix: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for name, one in statistics.items():
        with open(f"{folder}/{prefix}_{name}.json", "w", encoding="utf-8") as f:
            json.dump(one, f, indent=2, ensure_ascii=False)
