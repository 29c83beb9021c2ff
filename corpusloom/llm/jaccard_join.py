"""N-gram Jaccard join: all links of similarity t or more between shingle sets, exactly, and their connected classes.

Equal sets are one node. Links are overlap counts of a blocked sparse product of the incidence matrix of sets by shingles;
which rows meet in a block is settled first. No step lists all pairs of a group.

1. Candidate clusters. The sizes are cut into classes so that linked sets lie in one class or in neighbouring ones.
   Two linked sets of up to h shingles each differ in at most d = 2h(1-t)/(1+t) shingles; so if the hash range is cut
   into more than d parts, they agree wholly in all but d of them (pigeonhole). Each set sends one signature per part
   that it fills. A set that fills no more parts than can differ might agree in empty parts only: it sends, beside
   these, the signatures of a second cut by another hash, and so on until it fills more, and after TURNS cuts each of its
   shingles. All sets of one signature are tied to one of them (a star, not all pairs), first within the task, then once
   per signature over all tasks; clusters are the components of these ties.
2. A cluster beyond a block's size may hang together by common passages. Its sets are ordered by how frequent their
   shingles are, rarest first, and by the size bound linked sets share one of their first n - ceil(t n) + 1: each set
   sends these, ties are made as above, and the cluster falls into the components of the ties. What moves grows with the sets.
3. Within a cluster, the product of its incidence matrix with its transpose accumulates overlap counts: shingles of few
   sets pair by pair into the counts, those of many in blocks of columns. Clusters still beyond a block's size (sets that
   share rare shingles) are dealt into blocks by size class and hash, and each pair of blocks whose size bounds
   allow a link is one unit of work of bounded size. A unit yields its linked sets' spanning forest and degrees, never pairs.
4. Components of the forests.

Word and shingle hashes have 64 bits. Nodes are named by 64 bits of a digest of the set; a second 64 bits are compared,
and a clash stops the run rather than joining two sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.core.components import connected_components, join_split
from corpusloom.core.workspace import cut
from corpusloom.llm.batches import map_batches, releasing, slices, texts
from corpusloom.llm.words import WordHashes, mix, shingle_set

#: A unit of step 3 holds two blocks of about so many shingles (8 bytes each) and sets at most.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 20, 2048
#: Shingles of more sets than FEW are multiplied as blocks of COLUMNS columns.
FEW, COLUMNS = 8, 4096
#: Cuts of step 1 after which a set sends its shingles one by one.
TURNS = 60
#: Counters of how frequent shingles are, in step 2: 1 MB whatever the input. They only order shingles, so that a
#: clash of two costs time and no link.
COUNTERS = 1 << 17
#: Bits of the filter that spares reading texts of no cluster a second time: 2 MB whatever the input.
FILTER_WORDS = 1 << 18


class Sizes:
    """Size classes for a threshold of percent / 100."""

    def __init__(self, percent: int):
        if not 70 <= percent <= 100:
            raise ValueError("the threshold is a percentage from 70 to 100")
        self.percent, self.low = percent, [1]
        self._parts: dict[int, int] = {}

    def _grow(self, n: int) -> None:
        while self.low[-1] <= n:
            self.low.append(max(self.low[-1] + 1, -(-self.low[-1] * 100 // self.percent)))

    def of(self, n: int) -> int:
        """The class of a set of n shingles."""
        self._grow(n)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def high(self, j: int) -> int:
        """The largest size of class j."""
        while len(self.low) <= j + 1:
            self._grow(self.low[-1])
        return self.low[j + 1] - 1

    def differ(self, n: int, j: int) -> int:
        """In how many shingles a set of n can differ from a linked one of class j or smaller, at most."""
        other = min(self.high(j), 100 * n // self.percent)
        return (100 - self.percent) * (n + other) // (100 + self.percent)

    def parts(self, j: int) -> tuple[int, int]:
        """(parts, shingles that a part must have to be signed) for class j, and for class j - 1 against it.

        As many shingles as allow, with few more parts, that most sets have more such parts than can differ: the more
        there are, the less likely do sets agree in one by a common passage.
        """
        if j not in self._parts:
            n = self.high(j)
            d = self.differ(n, j)
            self._parts[j] = next((k, c) for c in (6, 5, 4, 3, 2, 1) if (k := self._enough(n, d, c)))
        return self._parts[j]

    @staticmethod
    def _enough(n: int, d: int, c: int) -> int:
        """The least number of parts of which, for most sets of n, more than d have c shingles; 0 if that takes too many."""
        if d == 0:
            return int(c == 1)
        k = d + 1
        while c == 1 or k <= 1.3 * (d + 1):
            mean = n / k
            full = 1 - sum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(c))
            if k * full >= d + 0.5 + 0.5 * math.sqrt(k * full * (1 - full)):
                return k
            k += max(1, k // 100)
        return 0


def _cut(g: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, size, content) of each filled part of a sorted set: equal ranges of the hash, so each is a run."""
    part = (g >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    return part[at], np.diff(np.append(at, len(g))), np.add.reduceat(mix(g), at)


def signatures(grams: np.ndarray, sizes: Sizes) -> np.ndarray:
    """The 64-bit signatures of a sorted set."""
    n = len(grams)
    if not n:
        return np.empty(0, np.uint64)
    out = []
    own = sizes.of(n)
    for tag in (own, own + 1):
        (parts, least), differ = sizes.parts(tag), sizes.differ(n, tag)
        g, turn = grams, 0
        while True:
            part, size, content = _cut(g, parts)
            good = size >= least
            out.append(mix(content[good] + mix(part[good] + np.uint64((tag << 40) + (turn << 32) + 1))))
            # of more such parts than can differ, one agrees
            if np.count_nonzero(good) > differ:
                break
            turn += 1
            if turn >= TURNS:
                # of two linked sets, one that ended a cut has met the other there; two that did not share a shingle
                out.append(mix(grams + np.uint64((tag << 40) + 1)))
                break
            g = np.sort(mix(grams ^ np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
    return np.concatenate(out)


def node_of(grams: np.ndarray) -> tuple[int, int]:
    """(name, check) of a set: two signed 64-bit parts of one digest."""
    d = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


_hashes: WordHashes | None = None


def _sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    global _hashes
    if _hashes is None:
        _hashes = WordHashes()
    return [shingle_set(t.lower().split(), n, _hashes) for t in texts(batch, "t")]


def _names(documents: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: (id, n_shingles, node, node_check); an empty set has no node."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch, n)
        nodes = [node_of(g) if len(g) else (None, None) for g in sets]
        longs = [pa.array(map(len, sets), pa.int64()), pa.array([a for a, _ in nodes], pa.int64()), pa.array([b for _, b in nodes], pa.int64())]
        return pa.record_batch([batch.column("i"), *longs], names=["id", "n_shingles", "node", "node_check"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"id {kind}, n_shingles bigint, node bigint, node_check bigint")


def _ties(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by (sig, node): which rows are a signature's first, and the distinct (first, other) ties."""
    first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.empty(0, bool)
    hub = node[first][np.cumsum(first) - 1]
    other = node != hub
    return first, *np.unique(np.stack([hub[other], node[other]]), axis=1)


def _tie_rows(keys: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
    """(key, node, tied) of sets with their keys and names: one node each key, and where tied is set, a tie found here."""
    key, node = np.concatenate(keys), np.repeat(np.array(names, np.int64), [len(k) for k in keys])
    order = np.lexsort((node, key))
    first, hub, other = _ties(key[order], node[order])
    # in the order of the sets again: equal names side by side pack well in the shuffle
    order = np.sort(order[first])
    key, node = key[order].view(np.int64), node[order]
    tied = np.concatenate([np.zeros(len(key), np.int64), other])
    mask = np.arange(len(tied)) < len(key)
    # a tie rides along under its own node's name
    return pa.record_batch([pa.array(np.concatenate([key, other])), pa.array(np.concatenate([node, hub])), pa.array(tied, mask=mask)], names=["key", "node", "tied"])


def _signature_rows(documents: DataFrame, n: int, percent: int, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(percent)
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "t"):
                sigs, names = [], []
                for g in _sets(batch, n):
                    if len(g) and (name := node_of(g)[0]) not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(name)
                        sigs.append(signatures(g, sizes))
                        names.append(name)
                if sigs:
                    yield _tie_rows(sigs, names)

    return documents.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(releasing(run), "key bigint, node bigint, tied bigint")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, node, tied) rows -> distinct ties (a, b), in streaming: only the open signature's hub is held."""
    open_sig = open_hub = None
    for b in batches:
        tied = b.column("tied")
        is_tie = tied.is_valid().to_numpy(zero_copy_only=False)
        sig, node = b.column("key").to_numpy(), b.column("node").to_numpy()
        a, c = node[is_tie], tied.drop_null().to_numpy()
        sig, node = sig[~is_tie], node[~is_tie]
        if len(sig):
            if open_sig is not None and sig[0] == open_sig:
                sig, node = np.concatenate(([open_sig], sig)), np.concatenate(([open_hub], node))
            first, hub, other = _ties(sig, node)
            open_sig, open_hub = sig[-1], node[np.flatnonzero(first)[-1]]
            a, c = np.concatenate([a, hub]), np.concatenate([c, other])
        if len(a):
            a, c = np.unique(np.stack([a, c]), axis=1)
            yield pa.record_batch([pa.array(a), pa.array(c)], names=["a", "b"])


def _met(rows: DataFrame) -> DataFrame:
    """Distinct (a, b) of nodes that share a key with a common hub."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(releasing(_meet), "a bigint, b bigint").distinct()


def candidate_ties(documents: DataFrame, n: int, percent: int, text_col: str) -> DataFrame:
    return _met(_signature_rows(documents, n, percent, text_col))


# -- step 2


def _counted(documents: DataFrame, members: DataFrame, n: int, id_col: str, text_col: str) -> np.ndarray:
    """How often shingles are in the members' sets, by COUNTERS remainders of their hash."""
    size = COUNTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            if b.num_rows:
                every = np.concatenate([np.frombuffer(g.as_buffer(), np.uint64) for g in b.column("grams")])
                n += np.bincount((every % np.uint64(size)).astype(np.int64), minlength=size)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at), pa.array(n[at])], names=["at", "n"])

    rows = _read_sets(documents, members, n, id_col, text_col, run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefix(grams: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, of which it shares one with each linked set."""
    n = len(grams)
    first = n - -(-percent * n // 100) + 1
    return grams[np.lexsort((grams, counts[(grams % np.uint64(len(counts))).astype(np.int64)]))[:first]]


def _parted(documents: DataFrame, members: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """members of large clusters, each cluster parted into the components of the ties by rare shingles."""
    held = documents.sparkSession.sparkContext.broadcast(_counted(documents, members, n, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [prefix(np.frombuffer(g.as_buffer(), np.uint64), held.value, percent) for g in b.column("grams")]
            if keys:
                yield _tie_rows(keys, b.column("node").to_pylist())

    rows = _read_sets(documents, members, n, id_col, text_col, run, "key bigint, node bigint, tied bigint")
    # a set without a tie links with none
    return members.join(connected_components(_met(rows)), "node").withColumn("cluster", F.xxhash64("cluster", "component")).drop("component")


# -- step 3


def overlaps(grams: list[np.ndarray]) -> np.ndarray:
    """Sizes of the sets' intersections (the diagonal is not filled in): the incidence matrix by its transpose."""
    m = len(grams)
    owner = np.repeat(np.arange(m, dtype=np.int32), [len(g) for g in grams])
    flat = np.concatenate(grams)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    del order
    at = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    df = np.diff(np.append(at, len(flat)))
    counts = np.zeros((m, m), np.int32)
    flat_counts = counts.reshape(-1)
    # a shingle of few sets: one more for each two of them
    for d in range(2, FEW + 1):
        for some in np.array_split(at[df == d], max(1, np.count_nonzero(df == d) * d // 500_000)):
            own = owner[some[:, None] + np.arange(d)]
            for k in range(1, d):
                a, b = own[:, :-k].ravel().astype(np.int64), own[:, k:].ravel().astype(np.int64)
                np.add.at(flat_counts, np.concatenate([a * m + b, b * m + a]), 1)
    # shingles of many: blocks of columns; a block's counts are below 2^24, exact in single precision
    many = at[df > FEW]
    sizes = df[df > FEW]
    for c in range(0, len(many), COLUMNS):
        size = sizes[c : c + COLUMNS]
        entry = np.repeat(many[c : c + COLUMNS] - np.cumsum(size) + size, size) + np.arange(size.sum())
        rows, row = np.unique(owner[entry], return_inverse=True)  # only sets with a shingle in this block
        block = np.zeros((len(rows), len(size)), np.float32)
        block[row, np.repeat(np.arange(len(size)), size)] = 1
        for i in range(0, len(rows), 512):
            counts[np.ix_(rows[i : i + 512], rows)] += (block[i : i + 512] @ block.T).astype(np.int32)
    return counts


def overlap_links(grams: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix of linked sets. With ``side`` (0 or 1 each), links within one side count for nothing."""
    n = np.array([len(g) for g in grams], np.int64)
    counts = overlaps(grams)
    link = np.zeros(counts.shape, bool)
    for i in range(0, len(n), 512):
        part = slice(i, i + 512)
        inter, both = counts[part].astype(np.int64), n[part, None] + n[None, :]
        bound = np.minimum(n[part, None], n[None, :]) * 100 >= percent * np.maximum(n[part, None], n[None, :])
        link[part] = bound & (100 * inter >= percent * (both - inter)) & (inter > 0)
        if side is not None:
            link[part] &= side[part, None] != side[None, :]
    np.fill_diagonal(link, False)
    return link


def forest(link: np.ndarray) -> np.ndarray:
    """Of each row the smallest row of its component."""
    label = np.arange(len(link))
    seen = np.zeros(len(link), bool)
    for i in range(len(link)):
        if seen[i]:
            continue
        seen[i] = True
        front = np.array([i])
        while front.size:
            label[front] = i
            front = np.flatnonzero(link[front].any(axis=0) & ~seen)
            seen[front] = True
    return label


def _unit(at: list[int], rows: list[tuple], percent: int) -> list[tuple[int, int, int]]:
    """rows (node, grams, copies, side) of the unit at (cluster, j, x, k, y) -> (root, node, linked documents)."""
    grams = [np.frombuffer(r[1], np.uint64) for r in rows]
    side = np.array([r[3] for r in rows])
    link = overlap_links(grams, percent, None if at[1:3] == at[3:] else side)
    copies = np.array([r[2] for r in rows], np.int64)
    degree = np.array([copies[row].sum() for row in link])
    label = forest(link)
    return [(rows[label[i]][0], rows[i][0], int(degree[i])) for i in np.flatnonzero(degree)]


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[tuple]]]:
    """(key, rows without the key) of each unit of two or more nodes, out of rows sorted by unit and node."""
    key, held = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            at, rest = list(row[:5]), row[5:]
            if at != key:
                if len(held) > 1:
                    yield key, held
                key, held = at, []
            if not held or held[-1][0] != rest[0]:  # rows repeated with their id give the set again
                held.append(rest)
    if len(held) > 1:
        yield key, held


def _units(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        record = lambda rows: pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["a", "b", "degree"])
        for at, rows in _by_unit(batches):
            out += _unit(at, rows, percent)
            if len(out) > 10_000:
                yield record(out)
                out = []
        if out:
            yield record(out)

    return run


def _filter_hash(ids: np.ndarray, words: int) -> np.ndarray:
    h = mix(ids.view(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return np.stack([h % np.uint64(words * 64), (h >> np.uint64(32)) % np.uint64(words * 64)])


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of the nodes: FILTER_WORDS words whatever their number."""
    words = FILTER_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(words, np.uint64)
        for b in batches:
            at = _filter_hash(b.column(0).to_numpy(), words).ravel()
            np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(bits)
        yield pa.record_batch([pa.array(at), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

    rows = nodes.select("node").mapInArrow(releasing(run), "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(words, np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _read_sets(documents: DataFrame, members: DataFrame, n: int, id_col: str, text_col: str, work: Callable | None = None, schema: str = "") -> DataFrame:
    """(rep, node, grams): the shingle sets of the documents that stand for the members' nodes; or what work makes of their
    batches, in the same worker: a step of its own would take a second one for each task."""
    held = documents.sparkSession.sparkContext.broadcast(_node_filter(members.select(F.xxhash64("rep").alias("node"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for whole in batches:
            at = _filter_hash(whole.column("h").to_numpy(), len(bits))
            hit = np.all(bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1), axis=0)
            for batch in slices(whole.filter(pa.array(hit)), "t"):
                keep: dict[tuple, np.ndarray] = {}
                for i, g in zip(batch.column("i").to_pylist(), _sets(batch, n), strict=True):
                    if len(g):
                        keep.setdefault((i, node_of(g)[0]), g)
                if keep:
                    yield pa.record_batch([pa.array([i for i, _ in keep], batch.column("i").type), pa.array([k for _, k in keep], pa.int64()), pa.array([g.tobytes() for g in keep.values()], pa.binary())], names=["rep", "node", "grams"])

    kind = documents.schema[id_col].dataType.simpleString()
    read = documents.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), F.xxhash64(F.col(f"`{id_col}`")).alias("h")).where("i is not null")
    if work is not None:
        return read.mapInArrow(releasing(lambda batches: work(run(batches))), schema)
    return read.mapInArrow(releasing(run), f"rep {kind}, node bigint, grams binary")


_KEY = ["cluster", "j", "x", "k", "y"]


def _clusters(members: DataFrame) -> DataFrame:
    """(cluster, m, large): the number of its members, and whether they are more than a block holds."""
    whole = members.groupBy("cluster").agg(F.sum("size").alias("w"), F.count("*").alias("m"))
    return whole.select("cluster", "m", ((F.col("w") > BLOCK_SHINGLES) | (F.col("m") > BLOCK_SETS)).alias("large"))


def _dealt(members: DataFrame, total: int, most: int, percent: int) -> DataFrame:
    """Members (cluster, node, rep, copies, size), each once for every unit that it takes part in: with _KEY and side.

    Only names and sizes are dealt here; the sets join them afterwards, once.
    """
    sizes = Sizes(percent)
    sizes._grow(1 << 40)
    bounds = F.array(*[F.lit(x) for x in sizes.low])
    members = members.withColumn("class", F.size(F.filter(bounds, lambda b: b <= F.col("size"))) - 1)
    members = join_split(members, _clusters(members).where("m > 1"), ["cluster"], "m", total, most).drop("m")
    blocks = F.greatest(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).cast("int")
    large = members.where("large")
    per = large.groupBy("cluster", "class").agg(blocks.alias("nb"), F.count("*").alias("m"))
    none = F.lit(0).cast("int")
    out = [*_KEY, "node", "rep", "copies", "side"]
    small = members.where("not large").select("cluster", *[none.alias(k) for k in _KEY[1:]], "node", "rep", "copies", none.alias("side"))
    # own class: blocks x <= y; neighbouring classes: every x against every y
    up = per.select("cluster", (F.col("class") - 1).alias("class"), F.col("nb").alias("nb_up"))
    down = per.select("cluster", (F.col("class") + 1).alias("class"), F.col("nb").alias("nb_down"))
    per = per.join(up, ["cluster", "class"], "left").join(down, ["cluster", "class"], "left")
    dealt = join_split(large, per, ["cluster", "class"], "m", total, most).withColumn("b", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    c, b = F.col("class"), F.col("b")
    unit = lambda j, x, k, y, side: F.struct(j.alias("j"), x.alias("x"), k.alias("k"), y.alias("y"), side.cast("int").alias("side"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.transform(upto(F.col("nb")), lambda y: unit(c, F.least(b, y), c, F.greatest(b, y), F.when(b > y, F.lit(1)).otherwise(F.lit(0))))
    above = F.transform(upto(F.coalesce(F.col("nb_up"), F.lit(0))), lambda y: unit(c, b, c + 1, y, F.lit(0)))
    below = F.transform(upto(F.coalesce(F.col("nb_down"), F.lit(0))), lambda x: unit(c - 1, x, c, b, F.lit(1)))
    dealt = dealt.select("cluster", "node", "rep", "copies", F.explode(F.concat(own, above, below)).alias("u")).select("cluster", "u.j", "u.x", "u.k", "u.y", "node", "rep", "copies", "u.side")
    return small.select(*out).union(dealt.select(*out))


def _classes(documents: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: (id, n_shingles, node, low, n_links). low is (id, node) of the first document of the class;
    node and low are null where a document takes no part."""
    names = cut(_names(documents, n, id_col, text_col), "sets")
    known = names.where("id is not null and node is not null")
    # one document to read each set from
    rep = known.groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("size"), (F.min("node_check") != F.max("node_check")).alias("clash"))
    seen = Observation()
    rep = cut(rep.observe(seen, F.sum("copies").alias("rows"), F.max("copies").alias("most"), F.bool_or("clash").alias("clash")).drop("clash"), "nodes")
    totals = seen.get if rep.limit(1).count() else {"rows": 0, "most": 0, "clash": False}
    if totals["clash"]:
        raise RuntimeError("two different sets have one 64-bit name")
    with_id = documents.where(F.col(f"`{id_col}`").isNotNull())
    clusters = connected_components(candidate_ties(with_id, n, percent, text_col)).withColumnRenamed("component", "cluster")
    members = cut(clusters.join(rep, "node"), "members")
    total, most, some = _clusters(members).agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0)), F.bool_or("large")).first()
    if some:
        large = join_split(members, _clusters(members), ["cluster"], "m", total, most).drop("m")
        parted = _parted(documents, large.where("large").drop("large"), n, percent, id_col, text_col)
        members = cut(large.where("not large").drop("large").unionByName(parted), "parted")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = _dealt(members, total, most, percent).join(_read_sets(documents, members, n, id_col, text_col), ["node", "rep"])
    units = units.select(*_KEY, "node", "grams", "copies", "side").repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "node")
    links = cut(units.mapInArrow(releasing(_units(percent)), "a bigint, b bigint, degree bigint"), "links")
    component = connected_components(links)
    degree = links.groupBy(F.col("b").alias("node")).agg(F.sum("degree").alias("degree"))
    placed = cut(rep.join(component, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    low = placed.groupBy("component").agg(F.min(F.struct("rep", "node")).alias("low"), F.count("*").alias("m"))
    placed = join_split(placed, low, ["component"], "m", totals["rows"], most).join(degree, "node", "left")
    placed = cut(placed.select("node", "low", "copies", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "found")
    out = join_split(known.select("id", "n_shingles", "node"), placed, ["node"], "copies", totals["rows"], totals["most"]).drop("copies")
    rest = names.where("id is null or node is null").select("id", "n_shingles", F.lit(None).cast("bigint").alias("node"))
    return out.unionByName(rest, allowMissingColumns=True)


def jaccard_classes(documents: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (<id_col>, n_shingles, component_id, n_links).

    Words are runs of non-white-space, A-Z lower-cased; a document's set has its distinct n-word shingles, or the whole
    sequence as one if it has fewer words. Documents link when 100 * intersection >= percent * union. component_id is
    the smallest id reachable by links, n_links the number of other documents linked with it directly.

    Null or empty texts and texts without words link with nothing. A row without id takes no part: its component_id is
    null and its n_links 0. Rows repeated with id and text are linked with one another. Texts are read whole, however
    long. An empty table gives an empty result. Other columns are not read.
    """
    out = _classes(documents, n, percent, id_col, text_col)
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("low.rep", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(documents: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents with one of each class: the one of the smallest id, and there of the smallest set's name.

    Rows without id, and rows whose text has no words, stay. A repeated id is no reason to go: of rows that share an id,
    each is judged by its own text, and those without a link to one another stay beside each other. Of rows with one id
    and one set, the one with the smallest digest of all its columns stays.
    """
    classes = cut(_classes(documents, n, percent, id_col, text_col), "classes").where("id is not null")
    stays = (F.col("low.rep") == F.col("id")) & (F.col("low.node") == F.col("node"))
    counted = classes.groupBy("id").agg(F.bool_or(F.coalesce(stays, F.lit(True))).alias("stays"), F.count("*").alias("times"))
    counted = cut(counted, "stay")
    # Most rows stay, and an id that is surely not among the others needs no look-up: a filter of bounded size tells, and
    # only the texts that it does not clear are moved. Where it is full it clears none, and all are looked up.
    unsure = counted.where("not stays or times > 1")
    held = documents.sparkSession.sparkContext.broadcast(_node_filter(unsure.select(F.xxhash64("id").alias("node"))))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        at = _filter_hash(hashes.to_numpy(np.int64), len(held.value))
        return pd.Series(np.all(held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1), axis=0))

    names = [f"c{i}" for i in range(len(documents.columns))]
    rows = documents.select(*[F.col(f"`{c}`").alias(new) for c, new in zip(documents.columns, names, strict=True)])
    key, text = names[documents.columns.index(id_col)], names[documents.columns.index(text_col)]
    rows = rows.withColumn("hit", F.col(key).isNotNull() & maybe(F.xxhash64(key)))
    ids = counted.where("stays").select(F.col("id").alias("stay_id"), "times")
    looked_up = rows.where("hit").join(ids, F.col(key) == F.col("stay_id"))
    out = rows.where("not hit").select(*names).unionByName(looked_up.where("times = 1").select(*names))
    if counted.where("times > 1").limit(1).count():
        out = out.unionByName(_repeated(looked_up.where("times > 1"), classes.where(stays), names, key, text, n))
    return out.select(*[F.col(c).alias(old) for c, old in zip(names, documents.columns, strict=True)])


def _repeated(rows: DataFrame, first: DataFrame, names: list[str], key: str, text: str, n: int) -> DataFrame:
    """Of rows whose ids are repeated, those without words, and one each of the classes' first (id, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                sets = _sets(batch.rename_columns(["t" if c == text else c for c in batch.schema.names]), n)
                node = pa.array([node_of(g)[0] if len(g) else None for g in sets], pa.int64())
                yield pa.record_batch([*batch.columns, node], names=[*batch.schema.names, "node"])

    schema = T.StructType([*rows.select(*names).schema.fields, T.StructField("node", T.LongType())])
    rows = cut(rows.select(*names).mapInArrow(releasing(run), schema).withColumn("digest", F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)), "repeated")
    chosen = rows.where("node is not null").groupBy(key, "node").agg(F.min("digest").alias("digest"))
    chosen = chosen.join(first.select(F.col("id").alias(key), "node").distinct(), [key, "node"])
    # rows alike in all columns are one row for the digest: one of them is taken
    one = rows.join(chosen, [key, "node", "digest"]).groupBy(key, "node", "digest").agg(*[F.first(c).alias(c) for c in names if c != key])
    return rows.where("node is null").select(*names).unionByName(one.select(*names))
