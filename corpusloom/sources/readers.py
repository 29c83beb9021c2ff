"""Sources: JSON lines, tab-separated sentence pairs, and pairs of line-aligned text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.pytext import has_tokens, strip


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One object a line; blank lines are passed over, and a bad line stops the run."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def parse_pairs(lines: DataFrame, min_words: int = 3, src_lang: str | None = None, tgt_lang: str | None = None, column: str = "value") -> DataFrame:
    """Lines ``src_id<TAB>src<TAB>tgt_id<TAB>tgt`` with a status: written, malformed or too_short; empty lines are gone.

    Ids of written lines must be numbers.
    """
    line = F.regexp_replace(F.col(column), "^\\uFEFF|\\r$", "")
    parts = F.split(line, "\t", -1)
    rows = lines.select(line.alias("line"), parts.alias("p")).where(F.length("line") > 0)
    whole = F.size("p") == 4
    at = lambda i: F.when(whole, F.get("p", F.lit(i)))
    short = ~(has_tokens(at(1), min_words) & has_tokens(at(3), min_words))
    status = F.when(~whole, "malformed").when(short, "too_short").otherwise("written")
    rows = rows.select(status.alias("status"), at(0).alias("a"), at(1).alias("src"), at(2).alias("b"), at(3).alias("tgt"))
    number = lambda c: F.when(F.col("status") == "written", F.col(c).cast("bigint"))
    return _languages(rows.select("status", number("a").alias("src_id"), "src", number("b").alias("tgt_id"), "tgt"), src_lang, tgt_lang)


def read_pairs(spark: SparkSession, path: str, **options) -> DataFrame:
    return parse_pairs(spark.read.text(path), **options)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, value): the lines of a text file by their place; the one use of an RDD here, to number lines over all splits."""
    lines = spark.read.text(path).rdd.zipWithIndex().map(lambda x: (x[1], x[0].value))
    return spark.createDataFrame(lines, "n bigint, value string")


def zip_lines(src: DataFrame, tgt: DataFrame, min_words: int = 3, src_lang: str | None = None, tgt_lang: str | None = None) -> DataFrame:
    """(n, value) of both sides put side by side, stripped, with a status; other numbers of lines are a ValueError."""
    counts = [d.count() for d in (src, tgt)]
    if counts[0] != counts[1]:
        raise ValueError(f"line count mismatch: {counts[0]} and {counts[1]}")
    body = F.when(F.startswith("value", F.lit("\ufeff")), F.substr("value", F.lit(2))).otherwise(F.col("value"))
    clean = lambda d, name: d.select("n", strip(body).alias(name))
    rows = clean(src, "src").join(clean(tgt, "tgt"), "n")
    status = F.when((F.col("src") == "") | (F.col("tgt") == ""), "malformed")
    status = status.when(~(has_tokens(F.col("src"), min_words) & has_tokens(F.col("tgt"), min_words)), "too_short").otherwise("written")
    return _languages(rows.select(status.alias("status"), "n", "src", "tgt"), src_lang, tgt_lang)


def read_aligned(spark: SparkSession, src_path: str, tgt_path: str, **options) -> DataFrame:
    return zip_lines(numbered_lines(spark, src_path), numbered_lines(spark, tgt_path), **options)


def _languages(df: DataFrame, src_lang: str | None, tgt_lang: str | None) -> DataFrame:
    for name, value in (("src_lang", src_lang), ("tgt_lang", tgt_lang)):
        if value is not None:
            df = df.withColumn(name, F.lit(value))
    return df


def written(rows: DataFrame) -> DataFrame:
    return rows.where("status = 'written'").drop("status")


def counters(rows: DataFrame) -> dict[str, int]:
    """read, malformed, too_short and written."""
    got = {r.status: r.n for r in rows.groupBy("status").agg(F.count("*").alias("n")).collect()}
    return {"read": sum(got.values()), **{k: got.get(k, 0) for k in ("malformed", "too_short", "written")}}
