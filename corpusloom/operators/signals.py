"""Signals on rows: they add metrics and reasons, and never drop a row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.core.rows import require, with_metrics, with_reasons
from corpusloom.functions.pytext import char_count, token_count


def length_ratio(df: DataFrame, src_field: str = "src", tgt_field: str = "tgt", min_ratio: float = 0.5, max_ratio: float = 2.0, unit: str = "words", length_slack: int | None = None) -> DataFrame:
    """metrics.len_ratio (target by source) and len_diff; flags pairs beyond the bounds and, if given, the slack."""
    if unit not in ("chars", "words"):
        raise ValueError(f"unit must be 'chars' or 'words', got {unit!r}")
    if length_slack is not None and length_slack < 0:
        raise ValueError(f"length_slack must be >= 0, got {length_slack}")
    require(df, src_field, tgt_field)
    size = token_count if unit == "words" else char_count
    src, tgt = (F.greatest(size(F.col(f"`{c}`")), F.lit(1)) for c in (src_field, tgt_field))
    df = with_metrics(df, len_ratio=tgt / src, len_diff=F.abs(tgt - src))
    flag = ~F.col("metrics.len_ratio").between(min_ratio, max_ratio)
    if length_slack is not None:
        flag &= F.col("metrics.len_diff") > length_slack
    return with_reasons(df, len_ratio_out_of_bounds=flag)


#: text column -> struct<label: string, score: double>
Predictor = Callable[[Column], Column]


def language(df: DataFrame, predict: Predictor, input_field: str = "text", lang_field: str = "original_code", metric_prefix: str = "glotlid", removal_reason: str = "wrong_lang", score_threshold: float = 0.5) -> DataFrame:
    """metrics.<prefix>_label and _score; a reason where the label differs from the row's or the score is low."""
    require(df, input_field)
    df = df.withColumn("_lid", predict(F.replace(F.col(f"`{input_field}`"), F.lit("\n"), F.lit(" "))))
    df = with_metrics(df, **{f"{metric_prefix}_label": F.col("_lid.label"), f"{metric_prefix}_score": F.col("_lid.score")})
    expected = F.col(f"`{lang_field}`") if lang_field in df.columns else F.lit(None).cast("string")
    wrong = ~F.col("_lid.label").eqNullSafe(expected) | (F.col("_lid.score") < score_threshold)
    return with_reasons(df, **{removal_reason: wrong}).drop("_lid")


def pair_language(
    df: DataFrame,
    predict: Predictor,
    src_field: str = "src",
    tgt_field: str = "tgt",
    src_lang_field: str = "src_lang",
    tgt_lang_field: str = "tgt_lang",
    src_lang: str | None = None,
    tgt_lang: str | None = None,
    score_threshold: float = 0.7,
    min_words: int = 0,
) -> DataFrame:
    """The same for both sides of a pair; a literal language overrides the row's. Pairs with a side of fewer than
    min_words words keep their predictions and get no reasons."""
    require(df, src_field, tgt_field)
    sides = {"src": (src_field, src_lang_field, src_lang), "tgt": (tgt_field, tgt_lang_field, tgt_lang)}
    for side, (field, _, _) in sides.items():
        df = df.withColumn(f"_{side}", predict(F.replace(F.col(f"`{field}`"), F.lit("\n"), F.lit(" "))))
    df = with_metrics(df, **{f"{s}_glotlid_{k}": F.col(f"_{s}.{k}") for s in sides for k in ("label", "score")})
    long = F.lit(True)
    if min_words > 0:
        long = (token_count(F.col(f"`{src_field}`")) >= min_words) & (token_count(F.col(f"`{tgt_field}`")) >= min_words)
    wrong = {}
    for side, (_, lang_field, literal) in sides.items():
        expected = F.lit(literal) if literal is not None else F.col(f"`{lang_field}`") if lang_field in df.columns else F.lit(None).cast("string")
        wrong[f"{side}_wrong_lang"] = long & (~F.col(f"_{side}.label").eqNullSafe(expected) | (F.col(f"_{side}.score") < score_threshold))
    return with_reasons(df, **wrong).drop("_src", "_tgt")


def marker_words(markers: dict[str, tuple[str, ...]]) -> Predictor:
    """A native predictor for a few languages: the label with most of its words in the text, ties to the first label;
    the score is that label's part of all such words. A stand-in where no trained model is at hand."""

    def predict(text: Column) -> Column:
        low = F.lower(F.coalesce(text, F.lit("")))
        hits = [F.regexp_count(low, F.lit(r"(?<![\p{L}\p{N}_])(?:" + "|".join(words) + r")(?![\p{L}\p{N}_])")) for words in markers.values()]

        def best(counts: Column) -> Column:
            total = sum((counts[i] for i in range(len(markers))), F.lit(0))
            ranked = F.array_max(F.array(*[F.struct(counts[i].alias("n"), F.lit(-i).alias("at"), F.lit(label).alias("label")) for i, label in enumerate(markers)]))
            score = F.when(total > 0, ranked["n"] / total).otherwise(F.lit(0.0))
            return F.struct(F.when(total > 0, ranked["label"]).otherwise(F.lit("und")).alias("label"), score.alias("score"))

        # a lambda's variable is counted once, and its result is no struct expression that the optimizer takes apart
        return F.transform(F.array(F.array(*hits)), best)[0]

    return predict


def fasttext_predictor(model_path: str) -> Predictor:
    """A fastText model, where that library is installed; loaded once a worker."""
    held: dict = {}

    @F.pandas_udf("struct<label: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if "model" not in held:
            import fasttext

            held["model"] = fasttext.load_model(model_path)
        got = [held["model"].predict((t or "").replace("\n", " "), k=1) for t in texts]
        return pd.DataFrame({"label": [g[0][0].removeprefix("__label__") for g in got], "score": [float(g[1][0]) for g in got]})

    return predict


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; null where a length is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def quality_estimate(df: DataFrame, encode: Callable, score: Callable, src_field: str = "src", tgt_field: str = "tgt", metric_key: str = "blaser_score", batch_size: int = 32) -> DataFrame:
    """metrics.<metric_key>: score(encode(sources), encode(targets)) in batches; both are pluggable and run on executors."""
    require(df, src_field, tgt_field)

    @F.pandas_udf("double")
    def estimate(src: pd.Series, tgt: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(src), batch_size):
            a, b = (encode([t or "" for t in side[i : i + batch_size]]) for side in (src, tgt))
            out += np.asarray(score(a, b), float).reshape(-1).tolist()
        return pd.Series(out, dtype=float)

    return with_metrics(df, **{metric_key: estimate(F.col(f"`{src_field}`"), F.col(f"`{tgt_field}`"))})


def embedding_cosine(df: DataFrame, encode: Callable, src_field: str = "src", tgt_field: str = "tgt", metric_key: str = "sonar_cosine") -> DataFrame:
    """metrics.<metric_key>: the cosine of both sides' embeddings."""
    require(df, src_field, tgt_field)

    @F.pandas_udf("array<double>")
    def embed(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(x) for x in v] for v in encode([t or "" for t in texts])])

    return with_metrics(df, **{metric_key: cosine(embed(F.col(f"`{src_field}`")), embed(F.col(f"`{tgt_field}`")))})
