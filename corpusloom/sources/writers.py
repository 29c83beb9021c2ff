"""Sinks: JSON lines, Parquet, and export of chosen columns."""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.core.rows import dotted
from corpusloom.core.workspace import filesystem

FORMATS = ("parquet", "jsonl")


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False, single: bool = False) -> None:
    """Null fields are left out unless keep_nulls. ``single`` gives one part file: for small results only."""
    df = df.coalesce(1) if single else df
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column by its dotted path, under the path as its name; null where there is no such path.

    Names given twice are taken once, with a warning.
    """
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        print(f"columns given more than once: {twice}", file=sys.stderr)
    out = []
    for c in dict.fromkeys(columns):
        column = dotted(df, c)
        out.append((F.lit(None).cast("string") if column is None else column).alias(c))
    return df.select(*out)


def export(df: DataFrame, output: str, columns: list[str], format: str = "parquet", compression: str = "zstd", single: bool = False) -> dict:
    """Write the projection; returns what was written, counted while it is."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {format!r}")
    if not columns:
        raise ValueError("columns must be a list of at least one name")
    began = time.perf_counter()
    seen = Observation()
    out = project(df, columns).observe(seen, F.count("*").alias("n"))
    if format == "jsonl":
        write_jsonl(out, output, keep_nulls=True, single=single)
        compression = None
    else:
        (out.coalesce(1) if single else out).write.mode("overwrite").option("compression", compression).parquet(output)
    fs, at = filesystem(df.sparkSession, output)
    return {
        "rows_written": seen.get["n"],
        "columns": list(dict.fromkeys(columns)),
        "format": format,
        "compression": compression,
        "output_bytes": fs.getContentSummary(at).getLength(),
        "output": output,
        "processing_time_s": round(time.perf_counter() - began, 3),
    }
