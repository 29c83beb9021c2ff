"""Functions over Arrow batches of texts, worked on some at a time: Spark's batches have so many rows, of any length."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that are Python strings at once, but for a longer text, which is alone.
PART_BYTES = 1 << 20


def parts(texts: pa.Array, limit: int = PART_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of texts, none empty, with at most limit bytes or one text each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = int(upto[start - 1]) if start else 0
        end = max(int(np.searchsorted(upto, before + limit, "right")), start + 1)
        yield texts.slice(start, end - start)
        start = end


def release() -> None:
    """Gives memory that is free back to the system: Spark keeps a worker for other tasks, beside their own ones."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def over_texts(kind: str, work: Callable[[list[str | None]], pa.Array]) -> Callable[[Column], Column]:
    """work(texts) -> values of the type named kind, as a function of columns."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in parts(batch):
                yield work(part.to_pylist())
        release()

    return run
