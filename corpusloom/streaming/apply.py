"""Stages that look at one row at a time run on streams as they are; corpus-wide ones run on each micro-batch's table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators import rules
from corpusloom.plans import pipeline


def clean_stream(stream: DataFrame, stages: list[pipeline.Stage]) -> DataFrame:
    """Cleaners and signals over a streaming DataFrame: no state, no watermark."""
    return pipeline.apply(stream, stages)


def filter_stream(stream: DataFrame, filters: list[dict]) -> tuple[DataFrame, DataFrame]:
    """(survivors, rejects) of a streaming DataFrame."""
    return rules.split(rules.judge(stream, filters))


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """work(table, batch number) on every micro-batch that is there now: for deduplication and statistics."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
