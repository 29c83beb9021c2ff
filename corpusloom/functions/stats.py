"""Statistics of whole columns: nearest-rank quantiles, histograms, most frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut

QUANTILES = (0.10, 0.50, 0.90, 0.99)


def nearest_rank(df: DataFrame, column: str, shares: tuple[float, ...] = QUANTILES) -> dict[float, object]:
    """{p: sorted(values)[min(int(n * p), n - 1)]} over non-null values; empty if there are none.

    Values are counted, dealt into ranges, and only the ranges' totals are summed up in one place: exact at any size,
    and no task sorts more than its range.
    """
    counts = df.select(F.col(column).alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("c"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(counts.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()), "ranges")
    totals = sorted((r.part, r.c) for r in dealt.groupBy("part").agg(F.sum("c").alias("c")).collect())
    n = sum(c for _, c in totals)
    if not n:
        return {}
    wanted = {p: min(int(n * p), n - 1) for p in shares}
    where, before = {}, 0
    for part, c in totals:
        for p, k in wanted.items():
            if before <= k < before + c:
                where[p] = (part, k - before)
        before += c
    upto = F.sum("c").over(Window.partitionBy("part").orderBy("v"))
    ranked = dealt.where(F.col("part").isin(sorted({part for part, _ in where.values()}))).withColumn("upto", upto)
    cols = [F.min(F.when((F.col("part") == part) & (F.col("upto") > k), F.col("v"))).alias(f"q{i}") for i, (part, k) in enumerate(where.values())]
    row = ranked.agg(*cols).first()
    return dict(zip(where, row, strict=True))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column, null included."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def map_totals(df: DataFrame, column: str) -> DataFrame:
    """(key, n): the sums of a map column's values over all rows, by key."""
    return df.select(F.explode(column).alias("key", "k")).groupBy("key").agg(F.sum("k").alias("n"))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (value, n); ties by value."""
    return histogram(df, column).orderBy(F.desc("n"), "value").limit(k)
