"""Near-duplicate clusters: MinHash, banding, stars to each band's smallest row, connected components."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.core.batches import parts, release
from corpusloom.core.components import connected_components
from corpusloom.core.rows import with_metrics
from corpusloom.core.workspace import cut

PRIME = (1 << 31) - 1
_WORD = re.compile(r"\w+")
try:  # without the cost of OpenSSL's contexts, for strings as short as these
    from _md5 import md5
except ImportError:
    from hashlib import md5


@lru_cache
def band_shape(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows) with the least sum of the areas of wrong positives below and wrong negatives above the threshold."""
    x = np.linspace(0, 1, 2001)
    mid = (x[1:] + x[:-1]) / 2
    width = x[1] - x[0]
    best = None
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            hit = 1 - (1 - mid**r) ** b
            cost = 0.5 * hit[mid < threshold].sum() * width + 0.5 * (1 - hit[mid >= threshold]).sum() * width
            if best is None or cost < best[0] - 1e-12:
                best = (cost, b, r)
    return best[1], best[2]


@lru_cache
def permutations(num_perm: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers below 2^30 and offsets of the hash family, from a fixed linear congruential sequence."""
    x, out = 12345, []
    for _ in range(2 * num_perm):
        x = (1103515245 * x + 12345) % (1 << 31)
        out.append(x)
    return np.array([1 + v % ((1 << 30) - 1) for v in out[::2]], np.int64), np.array([v % PRIME for v in out[1::2]], np.int64)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def signature(words: list[str], ngram_size: int, num_perm: int) -> np.ndarray | None:
    """Minima of the hashed n-grams of tokens; None without tokens. Fewer tokens than a gram make one gram."""
    if not words:
        return None
    joined = " ".join(words).encode()  # tokens have no blanks, so each blank is a border, and a gram is a piece
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist()
    starts, ends = [0, *[i + 1 for i in blanks]], [*blanks, len(joined)]
    grams = {joined[i:j] for i, j in zip(starts, ends[min(ngram_size, len(words)) - 1 :], strict=False)}
    h = np.frombuffer(b"".join([md5(g).digest()[:4] for g in grams]), ">u4").astype(np.int64) % PRIME
    a, b = permutations(num_perm)
    out = np.full(num_perm, PRIME, np.int64)
    for i in range(0, len(h), 256):
        # x + 1, above 0, folded twice at 31 bits is (x % PRIME) + 1
        x = a[:, None] * h[None, i : i + 256]
        x += b[:, None] + 1
        y = x >> 31
        x &= PRIME
        x += y
        np.right_shift(x, 31, out=y)
        x &= PRIME
        x += y
        out = np.minimum(out, x.min(axis=1) - 1)
    return out


def clusters(df: DataFrame, id_col: str = "id", text_field: str = "text", threshold: float = 0.8, ngram_size: int = 5, num_perm: int = 128, min_length: int = 5) -> DataFrame:
    """(<id_col>, dedup_cluster_id, dedup_keeper) of rows with distinct ids.

    A cluster's id is its smallest row's id, and that row is the keeper. Rows of fewer than min_length tokens are
    clusters of their own, with id -(id + 1).
    """
    bands, rows = band_shape(threshold, num_perm)

    def run(batches):
        for batch in batches:
            at = 0
            for part in parts(batch.column("t")):
                yield signed_part(batch.column("i").slice(at, len(part)), part)
                at += len(part)
        release()

    def signed_part(keys, texts):
        ids, band, digest, short = [], [], [], []
        for i, text in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
            words = tokens(text or "")
            if len(words) < max(1, min_length):
                ids.append(i)
                band.append(None)
                digest.append(None)
                short.append(True)
                continue
            s = signature(words, ngram_size, num_perm)
            for k in range(bands):
                ids.append(i)
                band.append(k)
                digest.append(hashlib.blake2b(s[k * rows : (k + 1) * rows].tobytes(), digest_size=16).digest())
                short.append(False)
        return pa.record_batch([pa.array(ids, keys.type), pa.array(band, pa.int32()), pa.array(digest, pa.binary()), pa.array(short, pa.bool_())], names=["id", "band", "digest", "short"])

    kind = df.schema[id_col].dataType.simpleString()
    signed = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_field}`").alias("t")).mapInArrow(run, f"id {kind}, band int, digest binary, short boolean")
    signed = cut(signed, "bands")
    # stars to the smallest row: the minimum is partially aggregated, so a band of very many rows moves one row a task
    hubs = signed.where("not short").groupBy("band", "digest").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    edges = signed.join(hubs, ["band", "digest"]).where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    component = connected_components(edges)
    every = signed.select("id", "short").distinct()
    out = every.join(component, every["id"] == component["node"], "left")
    cluster = F.when(F.col("short"), -(F.col("id") + 1)).otherwise(F.coalesce("component", "id"))
    out = out.select(F.col("id").alias(id_col), cluster.alias("dedup_cluster_id"), "short", "component")
    return out.withColumn("dedup_keeper", F.col("short") | (F.coalesce("component", id_col) == F.col(id_col))).drop("short", "component")


def mark_duplicates(df: DataFrame, id_col: str = "id", text_field: str = "text", **minhash) -> DataFrame:
    """df with metrics.dedup_cluster_id and metrics.dedup_keeper; no row is dropped."""
    found = clusters(df, id_col, text_field, **minhash).select(F.col(id_col).alias("_id"), F.col("dedup_cluster_id").alias("_c"), F.col("dedup_keeper").alias("_k"))
    joined = df.join(found, df[id_col] == found["_id"], "left")
    return with_metrics(joined, dedup_cluster_id=F.col("_c"), dedup_keeper=F.col("_k")).drop("_id", "_c", "_k")


def statistics(marked: DataFrame) -> dict:
    """rows_total, clusters_total, clusters_with_duplicates, rows_kept and rows_dropped of marked rows."""
    sizes = marked.groupBy("metrics.dedup_cluster_id").agg(F.count("*").alias("n"))
    r = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") > 1)).first()
    return {"rows_total": r[0], "clusters_total": r[1], "clusters_with_duplicates": r[2], "rows_kept": r[1], "rows_dropped": r[0] - r[1]}
