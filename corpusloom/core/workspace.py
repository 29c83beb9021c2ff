"""Intermediate tables that survive the loss of executors.

Everything goes below the folder that the cluster names in ``spark.checkpoint.dir``, which the driver and all
executors share. Only where that is unset (local sessions, tests) a folder below the warehouse is used instead.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, without a slash at its end."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/corpusloom-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame, label: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back: computed once, short lineage, no executor-local blocks."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_stage(spark: SparkSession, build: Callable[[], DataFrame], label: str, spent: str | None = None) -> tuple[DataFrame, str]:
    """(what build makes, written and read back; its path). Tables that build wrote on the way are dropped, and ``spent``,
    the path of its input, too."""
    mark = len(_written)
    out = cut(build(), label)
    *way, (_, path) = _written[mark:]
    for _, old in [*way, *([(spark, spent)] if spent else [])]:
        drop(spark, old)
    _written[:] = [w for w in _written[:mark] if w[1] != spent] + [(spark, path)]
    return out, path


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of path."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop(spark: SparkSession, path: str) -> None:
    fs, at = filesystem(spark, path)
    fs.delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                drop(spark, path)
        except Exception:  # the session has ended: its folder is the cluster's to clean
            return
