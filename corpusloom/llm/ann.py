"""Approximate nearest neighbours by largest inner product: a hash-prefix forest.

A vector has one long hash string in each of TREES trees: the coordinates of largest magnitude after the tree's random
rotation, with their signs, largest first. Inner products are turned into angles by one more coordinate,
sqrt(longest^2 - |x|^2). Near vectors share long prefixes.

1. All strings are made once. A tree is the sorted array of its strings; all trees end to end are cut into ranges of about
   PART_STRINGS strings, so that a dense prefix spreads over ranges.
2. A query asks, over all trees together, for the likeliest beginnings of its neighbours' strings: orders of its own largest
   coordinates, of two symbols, or of one where a tree has too few strings for two. Each goes only to the ranges that have
   such strings, descends from there along the query's own string to the longest prefix that any string has, and
   ascends until the prefix has its share of strings. There are PROBES beginnings (from, to), and their shares add up to
   SPREAD * sqrt(rows) or more, in all trees alike.
3. The strings found are compared exactly, in double precision, where their vectors lie: blocks of vectors, to which a
   query travels only if it has candidates there.

A query that has found fewer than it asked for ascends to the roots: it is compared with all rows, block by block. Of equal
vectors, only the k + 1 of the smallest ids can be among the nearest, and only these have strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut

TREES, PROBES, SPREAD = 48, (1024, 12_000), 22.0
#: Own coordinates whose orders are asked for, and what the second of an order counts by the first.
WIDTH, SECOND = 16, 0.7
#: Strings in a range, and bytes of vectors in a block, about.
PART_STRINGS, BLOCK_BYTES = 1 << 18, 2 << 20
#: Vectors that say where the ranges end: a bounded sample, by hash of the row.
SAMPLE = 8_000
SEED = 11
#: Bits of a string below the number of its tree.
_STRING = 56


@lru_cache(2)
def _rotations(d: int, trees: int) -> np.ndarray:
    """[coordinate, tree, coordinate]: a random rotation for each tree."""
    r = np.random.Generator(np.random.Philox(SEED))
    return np.stack([np.linalg.qr(r.standard_normal((d, d)))[0] for _ in range(trees)], axis=1).astype(np.float32)


class Strings:
    """Hash strings of vectors of d coordinates, of symbols of so many bits: twice a coordinate's number, and its sign."""

    def __init__(self, d: int, longest: float, trees: int):
        self.d, self.longest, self.trees = d, longest, trees
        self.bits = int(2 * (d + 1) - 1).bit_length()
        self.symbols = max(1, min(7, _STRING // self.bits, d + 1))
        #: Symbols of a beginning that queries ask for, how many of these, and what each has to find at least.
        self.first, self.probes_, self.enough = min(2, self.symbols), 1, 1

    def ask(self, rows: int, spread: float, probes: tuple[int, int]) -> Strings:
        """Sets what queries ask for among so many rows."""
        want = spread * np.sqrt(rows)
        symbols = 2 * (self.d + 1)
        need = want * symbols * (symbols - 2) / max(1, rows)
        if self.first == 2 and need > probes[1]:
            self.first = 1
        if self.first == 1:
            need = want * symbols / max(1, rows)
        self.probes_ = int(np.ceil(need if self.first == 1 else max(need, probes[0])))
        self.enough = max(1, int(np.ceil(want / self.probes_)))
        return self

    def _rotated(self, x: np.ndarray) -> np.ndarray:
        return np.tensordot(x.astype(np.float32), _rotations(self.d + 1, self.trees), axes=1)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """[row, tree]: the tree's number and the string, as one whole number. Some hundred rows at a time."""
        step = max(1, (1 << 20) // (self.trees * (self.d + 1)))
        return np.concatenate([self._keys(vectors[i : i + step]) for i in range(0, len(vectors), step)] or [np.empty((0, self.trees), np.int64)])

    def _keys(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.longest
        spare = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        y = self._rotated(np.column_stack([scaled, spare]))
        order = np.argsort(-np.abs(y), axis=2)[:, :, : self.symbols]
        return self._joined(2 * order + (np.take_along_axis(y, order, 2) < 0), np.arange(self.trees)[None, :])

    def _joined(self, symbols: np.ndarray, tree: np.ndarray) -> np.ndarray:
        out = np.zeros(symbols.shape[:-1], np.int64)
        for i in range(symbols.shape[-1]):
            out |= symbols[..., i].astype(np.int64) << (_STRING - self.bits * (i + 1))
        return out | (tree.astype(np.int64) << _STRING)

    def probes(self, query: np.ndarray) -> np.ndarray:
        """The likeliest strings of a query's neighbours over all trees: other beginnings, and then its own order."""
        y = self._rotated(np.append(query / np.sqrt((query * query).sum()), 0.0)[None])[0]
        both = np.concatenate([y, -y], axis=1)
        width = min(WIDTH, self.d + 1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :width]
        high = np.take_along_axis(both, top, 1)
        symbol = 2 * (top % (self.d + 1)) + (top > self.d)
        if self.first == 1:
            score, pick = high, symbol[:, :, None]
        else:
            score = high[:, :, None] + SECOND * high[:, None, :]
            score[:, np.arange(width), np.arange(width)] = -np.inf
            pick = np.stack(np.broadcast_arrays(symbol[:, :, None], symbol[:, None, :]), axis=-1)
        score, pick = score.reshape(-1), pick.reshape(-1, self.first)
        best = np.argsort(-score, kind="stable")[: min(self.probes_, int(np.isfinite(score).sum()))]
        tree, begin = best // (len(score) // self.trees), pick[best]
        # the rest of the string: the query's own order without the coordinates at the beginning
        own = np.argsort(-np.abs(y), axis=1, kind="stable")[:, : self.symbols + self.first]
        own = (2 * own + (np.take_along_axis(y, own, 1) < 0))[tree]
        used = (own[:, :, None] // 2 == begin[:, None, :] // 2).any(axis=2)
        rest = np.take_along_axis(own, np.argsort(used, axis=1, kind="stable"), 1)[:, : self.symbols - self.first]
        return self._joined(np.concatenate([begin, rest], axis=1), tree)

    def range_of(self, key: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last key with the first ``length`` symbols of each key."""
        low = np.int64((1 << (_STRING - self.bits * length)) - 1)
        return key & ~low, key | low


def matches(strings: Strings, keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string asked for, the run of sorted keys to take: from the longest prefix, ascending until it has enough."""
    low, high = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    open_ = np.arange(len(asked))
    for length in range(strings.symbols, strings.first - 1, -1):
        a, z = strings.range_of(asked[open_], length)
        low[open_], high[open_] = np.searchsorted(keys, a, "left"), np.searchsorted(keys, z, "right")
        open_ = open_[high[open_] - low[open_] < strings.enough]
    return low, high


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    n = np.asarray(pc.list_value_length(column))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (n == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(n), d))
    out[np.arange(d)[None, :] < n[:, None]] = flat
    return out


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False))) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _spans(low: np.ndarray, times: np.ndarray) -> np.ndarray:
    """low, low + 1, ... of each run of so many, one run after another."""
    return np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _segments(keys: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of equal keys."""
    if len(keys[0]):
        change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        edges = np.flatnonzero(np.concatenate(([True], change, [True])))
        yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def _candidates(points: DataFrame, queries: DataFrame, strings: Strings, n: int, blocks: int) -> DataFrame:
    """(block, q, rows): for each query, by its id, the rows that it finds, by their hash; a row may come more than once."""
    d, trees = strings.d, strings.trees
    parts = max(1, -(-n * trees // PART_STRINGS))
    every = max(1, n // SAMPLE)
    held = points.where(F.pmod(F.xxhash64("r"), F.lit(every)) == 0).select("v").limit(2 * SAMPLE).toArrow().column("v").combine_chunks()
    ends = np.empty(0, np.int64)
    if len(held) and parts > 1:
        some = np.sort(strings.keys(_matrix(held, d)).ravel())
        ends = np.unique(some[np.arange(1, parts) * len(some) // parts])

    def record(part: np.ndarray, kind: int, by: np.ndarray, key: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(part.astype(np.int32)), pa.array(np.full(len(part), kind, np.int32)), pa.array(by), pa.array(key), pa.array(r)], names=["part", "kind", "by", "key", "r"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                some = b.slice(at, 1024)
                key = strings.keys(_matrix(some.column("v"), d)).ravel()
                yield record(np.searchsorted(ends, key, "right"), 0, key, key, np.repeat(some.column("r").to_numpy(), trees))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, v in zip(b.column("q").to_numpy(), _matrix(b.column("v"), d), strict=True):
                key = strings.probes(v)
                a, z = strings.range_of(key, strings.first)
                a, z = np.searchsorted(ends, a, "right"), np.searchsorted(ends, z, "right")
                part = _spans(a, z - a + 1)
                own = np.full(len(part), q)
                yield record(part, 1, own, np.repeat(key, z - a + 1), own)

    def found(q: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        block = rows % blocks
        order = np.lexsort((rows, block, q))
        q, rows, block = q[order], rows[order], block[order]
        new = np.concatenate(([True], (q[1:] != q[:-1]) | (rows[1:] != rows[:-1])))
        q, rows, block = q[new], rows[new], block[new]
        first = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (block[1:] != block[:-1]))))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(q)).astype(np.int32)), pa.array(rows))
        return pa.record_batch([pa.array(block[first].astype(np.int32)), pa.array(q[first]), lists], names=["block", "q", "rows"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, rows = None, [], []
        for b in batches:
            part, kind, key, r = (b.column(c).to_numpy() for c in ("part", "kind", "key", "r"))
            for a, z in _segments([part, kind]):
                if part[a] != now:
                    now, keys, rows = part[a], [], []
                if kind[a] == 0:
                    keys.append(key[a:z])
                    rows.append(r[a:z])
                    continue
                if len(keys) > 1:
                    keys, rows = [np.concatenate(keys)], [np.concatenate(rows)]
                if not keys:
                    continue
                low, high = matches(strings, keys[0], key[a:z])
                # some hundred thousand strings at a time, and one beginning at least
                upto = np.cumsum(high - low)
                at = 0
                while at < z - a:
                    to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 500_000, "right")))
                    times = high[at:to] - low[at:to]
                    if times.any():
                        yield found(np.repeat(r[a + at : a + to], times), rows[0][_spans(low[at:to], times)])
                    at = to

    schema = "part int, kind int, by bigint, key bigint, r bigint"
    both = points.select("r", "v").mapInArrow(index, schema).union(queries.select("q", "v").mapInArrow(ask, schema))
    both = both.repartitionById(len(ends) + 1, F.col("part")).sortWithinPartitions("part", "kind", "by")
    return both.mapInArrow(meet, "block int, q bigint, rows array<bigint>")


def _compared(points: DataFrame, queries: DataFrame, asked: DataFrame, blocks: int, d: int, k: int) -> DataFrame:
    """(query_id, id, score): the k best of each query in each block of vectors, of the rows that it asks for there.

    asked is (block, q, rows), rows null for all rows of the block.
    """
    rows = points.select(F.pmod("r", F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("q"), "r", "id", "v", F.lit(None).cast("array<bigint>").alias("rows"))
    none = F.lit(0).cast("bigint")
    vectors = asked.groupBy("block", "q").agg(F.bool_or(F.col("rows").isNull()).alias("all")).join(queries, "q")
    vectors = vectors.select("block", F.when(F.col("all"), F.lit(2)).otherwise(F.lit(1)).alias("kind"), "q", none.alias("r"), none.alias("id"), "v", F.lit(None).cast("array<bigint>").alias("rows"))
    lists = asked.where("rows is not null").select("block", F.lit(3).alias("kind"), "q", none.alias("r"), none.alias("id"), F.lit(None).cast("array<double>").alias("v"), "rows")

    def best(q: np.ndarray, at: np.ndarray, ask: np.ndarray, ids: np.ndarray, x: np.ndarray, vec: np.ndarray) -> pa.RecordBatch | None:
        """The k best of each query of pairs (q, at) of places in ask and in x."""
        fine = ids[at] != ask[q]
        q, at = q[fine], at[fine]
        score = np.concatenate([np.einsum("ij,ij->i", x[at[i : i + 20_000]], vec[q[i : i + 20_000]]) for i in range(0, len(q), 20_000)] or [np.empty(0)])
        order = np.lexsort((ids[at], -score, q))
        q, at, score = q[order], at[order], score[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, np.int64)
        keep = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
        if not keep.any():
            return None
        return pa.record_batch([pa.array(ask[q[keep]]), pa.array(ids[at[keep]]), pa.array(score[keep])], names=["query_id", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, last = None, [], (np.empty(0, np.int64), np.empty((0, d)))
        names = ids = x = None
        for b in batches:
            block, kind = b.column("block").to_numpy(), b.column("kind").to_numpy()
            for a, z in _segments([block, kind > 0]):
                part = b.slice(a, z - a)
                if block[a] != now:
                    now, held, x = block[a], [], None
                if kind[a] == 0:
                    held.append((part.column("r").to_numpy(), part.column("id").to_numpy(), _matrix(part.column("v"), d)))
                    continue
                if x is None:
                    if not held:
                        continue
                    names, ids, x = (np.concatenate(c) for c in zip(*held, strict=True))
                    order = np.argsort(names, kind="stable")
                    names, ids, x = names[order], ids[order], x[order]
                    held = []
                own = kind[a:z] < 3
                # the query that the segment before left off in comes first
                ask = np.concatenate([last[0], part.column("q").to_numpy()[own]])
                vec = np.concatenate([last[1], _matrix(part.filter(pa.array(own)).column("v"), d)])
                place = np.cumsum(own) - 1 + len(last[0])
                last = (ask[-1:], vec[-1:])
                for i in np.flatnonzero(kind[a:z] == 2):
                    if got := best(np.full(len(x), place[i]), np.arange(len(x)), ask, ids, x, vec):
                        yield got
                lists = part.filter(pa.array(~own)).column("rows")
                r = lists.flatten().to_numpy()
                q = np.repeat(place[~own], np.asarray(pc.list_value_length(lists)))
                lo, hi = np.searchsorted(names, r, "left"), np.searchsorted(names, r, "right")
                both = np.unique(np.repeat(q, hi - lo) * len(x) + _spans(lo, hi - lo))
                if got := best(both // len(x), both % len(x), ask, ids, x, vec):
                    yield got

    every = rows.union(vectors).union(lists).withColumn("late", F.col("kind") > 0)
    every = every.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "late", "q", "kind")
    return every.mapInArrow(run, "query_id bigint, id bigint, score double")


def search(vectors: DataFrame, query_where: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, spread: float = SPREAD, probes: tuple[int, int] = PROBES) -> DataFrame:
    """The k nearest found of each query row: (query_id, rank, <id_col>, score), rank from 1.

    query_where is over the column of ids. Candidates are all rows but those of the query's own id. Unusable vectors (see
    usable()) and rows without id take no part. Shorter vectors are filled up with zeros to the longest. Rows repeated
    with their id and vector are one; of rows that share an id, each vector is a candidate of its own, and the smallest
    asks. Ties go to smaller ids. Fewer candidates than k are returned all. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"), F.coalesce(query_where, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).dropDuplicates(["id", "v"])
    queries = cut(rows.where("q").groupBy(F.col("id").cast("bigint").alias("q")).agg(F.min("v").alias("v")), "queries")
    near = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    points = rows.select(F.col("id").cast("bigint").alias("id"), F.xxhash64("id", "v").alias("r"), "v").withColumn("n", near).where(F.col("n") <= k + 1).drop("n")
    points = cut(points, "points")
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, d, longest = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1)), F.coalesce(F.max(norm2), F.lit(1.0))).first()
    strings = Strings(d, float(np.sqrt(longest)) * (1 + 1e-9), trees).ask(n, spread, probes)
    blocks = max(1, -(-n * 8 * d // BLOCK_BYTES))
    asked = cut(_candidates(points, queries, strings, n, blocks), "candidates")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = lambda asked: _compared(points, queries, asked, blocks, d, k).withColumn("rank", rank).where(F.col("rank") <= k)
    found = cut(ranked(asked), "nearest")
    few = queries.join(found.groupBy(F.col("query_id").alias("q")).agg(F.count("*").alias("c")), "q", "left").where(F.coalesce("c", F.lit(0)) < min(k, n - 1))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    few = cut(few.select(every, "q", F.lit(None).cast("array<bigint>").alias("rows")), "few")
    if few.limit(1).count():
        found = found.join(few.select("q").distinct(), found["query_id"] == F.col("q"), "left_anti").unionByName(ranked(few))
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")
