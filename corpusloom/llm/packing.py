"""Packing of documents into sequences by patterns, fitted with non-negative least squares.

Only the histogram of piece lengths matters for a packing, and it has at most ``size`` bars whatever the input. On the
driver: enumerate patterns (few lengths that fill a sequence), fit how often each is used by non-negative least squares
to the histogram, round down, and pack the residual counts best-fit. The plan is a list of runs: "the pieces of length
L from rank a to rank b lie at offset o of sequences s, s+1, ...". On the executors: number the pieces of each length,
and look each number up in the plan. Texts are tokenised once and never shuffled.

A very common length is numbered in parts: pieces are dealt by hash into bins within their length, counted per bin, and
a piece's number is its number within the bin after the counts of the bins before.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut
from corpusloom.llm.batches import map_batches, texts
from corpusloom.llm.prefix_counts import byte_letters
from corpusloom.llm.words import LONGEST

#: Pieces of one length and bin that are numbered together, about.
BIN_ROWS = 50_000
#: Bytes of text whose words are held together: some 10 bytes each meanwhile.
STEP_BYTES = 3 << 20


# -- the plan


def patterns(lengths: np.ndarray, weights: np.ndarray, size: int, most: int) -> list[tuple[int, ...]]:
    """Patterns of up to ``most`` pieces out of the lengths that occur, each as full as the lengths allow.

    Every length starts patterns of one to ``most`` pieces: equal shares and greedy completions by the longest, the
    commonest and the best fitting lengths. So their number is a small multiple of the number of lengths.
    """
    have = np.sort(lengths)
    common = have[np.argsort(-weights[np.searchsorted(have, have)], kind="stable")][:32] if len(have) else have
    out: set[tuple[int, ...]] = set()

    def fit(room: int) -> int:
        i = int(np.searchsorted(have, room, "right")) - 1
        return int(have[i]) if i >= 0 else 0

    for first in have.tolist():
        out.add((first,))
        starts = [[first], *[[first] * k for k in range(2, most) if first * k <= size], *[[first, c] for c in common.tolist() if first + c <= size]]
        for start in starts:
            got, room = list(start), size - sum(start)
            while room > 0 and len(got) < most:
                # the rest in equal shares, the last by best fit
                share = fit(room if len(got) == most - 1 else room) if len(start) > 1 else fit(max(room // (most - len(got)), 1)) or fit(room)
                if not share:
                    break
                got.append(share)
                room -= share
            if room > 0 and len(got) == most:
                got.sort()
                if better := fit(room + got[-1]):
                    got[-1] = max(better, got[-1])
            out.add(tuple(sorted(got, reverse=True)))
            pair = fit(size - sum(start))
            if pair:
                out.add(tuple(sorted([*start, pair], reverse=True))[: most + 1])
    return sorted(p for p in out if sum(p) <= size and len(p) <= most)


def nnls(a_cols: list[tuple[np.ndarray, np.ndarray]], b: np.ndarray, scale: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that lowers |S(Ax - b)|, by cyclic coordinate descent; a_cols has each column's rows and values."""
    x = np.zeros(len(a_cols))
    s2 = scale * scale
    rest = b.astype(float).copy()
    norm = [float((v * v * s2[r]).sum()) for r, v in a_cols]
    target = 1e-9 * max(1.0, float(np.abs(b).sum()))
    for _ in range(rounds):
        moved = 0.0
        for j, (r, v) in enumerate(a_cols):
            step = max(float((v * s2[r] * rest[r]).sum()) / norm[j], -x[j])
            if step:
                x[j] += step
                rest[r] -= step * v
                moved += abs(step)
        if moved <= target:
            break
    return x


class Plan:
    """Runs (length, first rank, count, first sequence, offset), and the number of sequences."""

    def __init__(self, size: int):
        self.size, self.sequences = size, 0
        self.used: dict[int, int] = {}
        self.runs: list[tuple[int, int, int, int, int]] = []

    def add(self, pattern: tuple[int, ...], times: int) -> None:
        offset = 0
        for n in pattern:
            at = self.used.get(n, 0)
            self.runs.append((n, at, times, self.sequences, offset))
            self.used[n] = at + times
            offset += n
        self.sequences += times


def best_fit_counts(counts: dict[int, int], size: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (pattern, times). Bars are placed as wholes, so it takes no step per piece."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}  # room -> {pattern: bins}
    rooms: list[int] = []  # sorted

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if room not in open_bins:
            open_bins[room] = {}
            rooms.insert(int(np.searchsorted(rooms, room)) if rooms else 0, room)
        open_bins[room][pattern] = open_bins[room].get(pattern, 0) + times

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left > 0:
            i = int(np.searchsorted(rooms, n)) if rooms else 0
            if i < len(rooms):
                room = rooms[i]
                pattern, bins = next(iter(open_bins[room].items()))
                k = min(left, bins)
                open_bins[room].pop(pattern)
                if bins > k:
                    open_bins[room][pattern] = bins - k
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(i)
                put(room - n, (*pattern, n), k)
                left -= k
            else:
                per = size // n
                full, over = divmod(left, per)
                if full:
                    put(size - per * n, (n,) * per, full)
                if over:
                    put(size - over * n, (n,) * over, 1)
                left = 0
    for by in open_bins.values():
        yield from by.items()


def bound(counts: dict[int, int], size: int) -> int:
    """No packing has fewer sequences than this."""
    return -(-sum(n * c for n, c in counts.items()) // size)


def make_plan(counts: dict[int, int], size: int, most: int = 4) -> Plan:
    """The pattern packing of a histogram {length: pieces}."""
    plan = Plan(size)
    rest = {n: c for n, c in counts.items() if c > 0}
    if full := rest.pop(size, 0):
        plan.add((size,), full)
    if not rest:
        return plan
    lengths = np.array(sorted(rest))
    have = np.array([rest[n] for n in lengths.tolist()])
    # only patterns that fill a sequence: what cannot be put into one is left to the residual
    pats = [p for p in patterns(lengths, have, size, most) if 1000 * sum(p) >= 999 * size]
    rows = [np.unique(np.array(p), return_counts=True) for p in pats]
    cols = [(np.searchsorted(lengths, v), k.astype(float)) for v, k in rows]
    # a long piece left over costs more than a short one, which fits nearly anywhere
    x = nnls(cols, have, lengths / size + 0.02, max(20, min(200, 1_600_000 // len(cols)))) if cols else np.empty(0)
    # the longest first: rounding down leaves short pieces, which fill what is left
    order = sorted(range(len(pats)), key=lambda j: (-sum(pats[j]), tuple(-n for n in pats[j])))
    for j in order:
        v, k = rows[j]
        times = min([int(x[j] + 1e-9), *[rest[a] // b for a, b in zip(v.tolist(), k.tolist(), strict=True)]])
        if times > 0:
            plan.add(pats[j], times)
            for a, b in zip(v.tolist(), k.tolist(), strict=True):
                rest[a] -= times * b
    for p, times in best_fit_counts({n: c for n, c in rest.items() if c > 0}, size):
        plan.add(p, times)
    return plan


# -- tokens


#: Letters up to here are words of one piece; these marks after them are pieces of their own.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?|)#$%&*]*)")


class RunIds(dict):
    """Run without ASCII white space -> its token ids as little-endian bytes; no token reaches over white space.

    A new run of letters and marks after them is looked up as those two parts. A word of such letters is one piece, and
    normalising only lower-cases it, so it goes straight to the vocabulary's merges.
    """

    def __init__(self, path: str, most: int = 250_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        self.library.no_truncation()
        self.library.no_padding()
        self.letter, self.long = None, []
        spec = json.load(open(path, encoding="utf-8"))
        if spec["model"].get("end_of_word_suffix") and '[\\p{L}]+' in json.dumps(spec["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\"):
            self.letter = {b: c for c, b in byte_letters().items()}

    def fill(self, runs: set[bytes]) -> None:
        new = [r for r in runs if r not in self]
        if len(self) + 2 * len(new) > self.most:
            used = {r: self[r] for r in runs if r in self}
            self.clear()
            self.update(used)
        split, words, odd = [], set(), set()
        for r in new:
            m = _PLAIN.fullmatch(r.decode()) if self.letter is not None else None
            if m is None:
                odd.add(r)
            else:
                word, marks = m[1].encode(), m[2].encode()
                words.add(word)
                if marks:
                    odd.add(marks)
                    split.append((r, word, marks))
        self.long = [r for r in new if len(r) > LONGEST]
        self.long += [w for w in words if len(w) > LONGEST]
        self._encode([r for r in odd if r not in self])
        model, letter = self.library.model, self.letter
        lower: dict[bytes, bytes] = {}
        for w in words:
            if w not in self:
                low = w.decode().lower()
                if (ids := lower.get(low)) is None:
                    piece = low if low.isascii() else "".join(map(letter.__getitem__, low.encode()))
                    ids = lower[low] = array("I", [t.id for t in model.tokenize(piece)]).tobytes()
                self[w] = ids
        for r, word, marks in split:
            self[r] = self[word] + self[marks]

    def forget(self) -> None:
        """Drops the long runs of the last fill."""
        for r in self.long:
            self.pop(r, None)

    def _encode(self, runs: list[bytes]) -> None:
        for i in range(0, len(runs), 4096):
            part = runs[i : i + 4096]
            for r, e in zip(part, self.library.encode_batch_fast([x.decode() for x in part], add_special_tokens=False), strict=True):
                self[r] = np.array(e.ids, "<u4").tobytes()


_ids: dict[str, RunIds] = {}


def tokenised_pieces(documents: DataFrame, vocabulary: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document: its ids, then end_id, cut after every ``size`` ids."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocabulary not in _ids:
            _ids[vocabulary] = RunIds(vocabulary)
        known = _ids[vocabulary]
        runs = [r.split() for r in texts(batch, "t")]
        known.fill(set().union(*runs))
        end = np.array([end_id], "<u4").tobytes()
        owner, piece, start, length, crc = [], [], [], [], []
        for i, r in enumerate(runs):
            raw = b"".join([*map(known.__getitem__, r), end])
            for k, at in enumerate(range(0, len(raw), 4 * size)):
                part = raw[at : at + 4 * size]
                owner.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        known.forget()
        return pa.record_batch([batch.column("i").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]], names=["id", "piece", "start", "length", "ids_crc32"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint", STEP_BYTES)


def pack_documents(documents: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 0, most: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (<id_col>, piece, start, length, ids_crc32, sequence_id, offset).

    Null texts count as empty: their only id is end_id. Rows repeated with their id, and rows without id, are packed
    each for itself. Texts are read whole and only those of more than ``size`` ids are cut. Sequences hold at most ``size`` ids, gapless from offset 0. Other columns are not read. An empty
    table gives an empty result.
    """
    spark = documents.sparkSession
    pieces = cut(tokenised_pieces(documents, vocabulary, size, end_id, id_col, text_col), "pieces")
    bars = {r.length: r.c for r in pieces.groupBy("length").agg(F.count("*").alias("c")).collect()}  # at most size rows
    plan = make_plan(bars, size, most)
    bins = max(16, min(1 << 16, -(-max(bars.values(), default=0) // BIN_ROWS) * 4))
    binned = pieces.withColumn("bin", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(bins)).cast("int"))
    per = binned.groupBy("length", "bin").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("length").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # rows that tie in all of this are the same in every column, so it does not matter which is which
    own = F.row_number().over(Window.partitionBy("length", "bin").orderBy("id", "piece", "ids_crc32"))
    ranked = binned.withColumn("own", own).join(per.select("length", "bin", before.alias("before")), ["length", "bin"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).alias("rank"))
    # the runs: a few per length and pattern, so their number is bounded by the number of lengths
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    held = spark.sparkContext.broadcast(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = held.value
        key = (r[:, 0] << 48) + r[:, 1]
        for b in batches:
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(key, (b.column("length").to_numpy() << 48) + rank, "right") - 1
            yield pa.record_batch([*b.columns[:5], pa.array(r[at, 3] + rank - r[at, 1]), pa.array(r[at, 4])], names=[id_col, *b.schema.names[1:5], "sequence_id", "offset"])

    kind = documents.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
