"""Arrow batches of (id, text) rows, cut by bytes so that long texts do not add up."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on together.
BATCH_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of batch with about limit bytes of text each; a longer text is a part by itself."""
    col = batch.column(column)
    if batch.num_rows == 0:
        return
    if col.nbytes <= limit:
        yield batch
        return
    start, held = 0, 0
    for i in range(batch.num_rows):
        v = col[i]
        n = v.as_buffer().size if v.is_valid else 0
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def release() -> None:
    """Gives memory that is free back to the system: Arrow's pool and, where the C library can, its heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def releasing(run: Callable) -> Callable:
    """run, with its task's memory given back at the end: Spark keeps a worker for other stages, beside their own ones."""

    @functools.wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return inner


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, columns: dict[str, str], text: str, work: Callable, schema: str, limit: int = BATCH_BYTES) -> DataFrame:
    """work(record batch) -> record batch or None, over slices (of about limit bytes of text) of df's columns {new: old name}.

    Only those columns are read, under names of their own, so that no other column can clash.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                if (out := work(part)) is not None:
                    yield out

    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()]).mapInArrow(run, schema)
