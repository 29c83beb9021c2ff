"""Exact token counts at every prefix, by dynamic programming, for byte-level BPE vocabularies that drop white space.

Write a word's bytes as c1..cn. The BPE encoding of c1..ci ends with exactly one token t, and what stands before t is
the encoding of the shorter prefix. So count(i) = count(i - len(t)) + 1, where t is the token that ends at i and is
stable after the last token of the shorter prefix: no merge across their border would have come first. One table holds
for every prefix its last token and its count; the word's end (tokens with the end-of-word mark) is one more lookup into
it. A truncation or budget question is then a search in a table of counts, and nothing is encoded again.

Distinct words of a batch go through the recurrence side by side in numpy; long words one by one. No token reaches over
white space, so a text's table of prefixes is kept as the counts at the ends of its runs, and within a run as those of
its bytes: prefix_store() gives the first, and truncations look the second up in the one run where the budget ends.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches, texts
from corpusloom.llm.words import LONGEST

_P = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(-1)
#: Words up to so many bytes are worked on side by side.
_WIDE = 40


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _poly(raw: bytes) -> int:
    h = 0
    for b in raw:
        h = (h * int(_P) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class _Lookup:
    """uint64 key -> int32 value, -1 where absent: an open table of one gather, and a search for the few that collide."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 20):
        self.shift = np.uint64(64 - bits)
        at = self.place(keys)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        first = np.unique(at, return_index=True)[1]
        self.keys[at[first]], self.values[at[first]] = keys[first], values[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.more, self.more_values = keys[rest], values[rest]
        self.crowded = np.zeros(1 << bits, bool)
        self.crowded[at[rest]] = True

    @staticmethod
    def _spread(keys: np.ndarray) -> np.ndarray:
        return (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (self._spread(keys) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys)
        out = np.where(self.keys[at] == keys, self.values[at], _NONE)
        if len(self.more) and (odd := np.flatnonzero((out < 0) & self.crowded[at])).size:
            j = np.minimum(np.searchsorted(self.more, keys[odd]), len(self.more) - 1)
            hit = self.more[j] == keys[odd]
            out[odd[hit]] = self.more_values[j[hit]]
        return out


class PrefixCounter:
    """Counts for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        splits = [p["pattern"].get("Regex") for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        if model["type"] != "BPE" or not self.end or len(splits) != 1 or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError(f"{path}: only byte-level BPE with an end-of-word mark is handled here")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.ascii_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
        if splits[0] != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
            self.ascii_pieces = None  # the library cuts ASCII text as well
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._number(model["vocab"], model["merges"])
        self._valid_seen: dict[int, bool] = {}

    def _number(self, vocab: dict[str, int], merges: list) -> None:
        """Own numbers: bytes, bytes at a word's end, then merges by rank; a lower number was made earlier."""
        of = byte_letters()
        names = [c for c in of] + [c + self.end for c in of]
        number = {n: i for i, n in enumerate(names)}
        left, right = list(range(len(names))), list(range(len(names)))
        pairs, made = [], []
        for m in merges:
            a, b = m.split(" ") if isinstance(m, str) else m
            if a + b in number:
                raise ValueError(f"two merges make {a + b!r}")
            number[a + b] = len(left)
            left.append(number[a])
            right.append(number[b])
            pairs.append(number[a] << 20 | number[b])
            made.append(number[a + b])
        missing = [n for n in number if n not in vocab]
        if missing:
            raise ValueError(f"not in the vocabulary: {missing[:3]}")
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.lefts, self.rights = left, right
        self.merged = _Lookup(np.array(pairs, np.uint64), np.array(made, np.int32))
        self.merged_at = dict(zip(pairs, made, strict=True))
        inner: dict[bytes, int] = {}
        final: dict[bytes, int] = {}
        for n, i in number.items():
            ends = n.endswith(self.end) and n != self.end
            raw = bytes(of[c] for c in (n[: -len(self.end)] if ends else n))
            (final if ends else inner)[raw] = i
        self.inner, self.final = inner, final
        as_table = lambda d: _Lookup(np.array([_poly(k) for k in d], np.uint64), np.array(list(d.values()), np.int32))
        self.inner_table, self.final_table = as_table(inner), as_table(final)
        self.finder = ahocorasick.Automaton()
        for raw, i in inner.items():
            self.finder.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.finder.make_automaton()
        self.inner_lengths = sorted({len(k) for k in inner}, reverse=True)
        self.final_lengths = sorted({len(k) for k in final}, reverse=True)

    # -- is a border between two tokens stable?

    def valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves a, b side by side as they are.

        Undo merges of the two tokens from the latest to the earliest; at each step a merge across the border that
        ranks before the one just undone would have been made first, and then the border is not stable.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << 30, np.int32)
        while live.size:
            m = self.merged(a.astype(np.uint64) << np.uint64(20) | b.astype(np.uint64))
            bad = (m >= 0) & (m < limit)
            ok[live[bad]] = False
            undo_a = a > b
            la, lb = self.right[a], self.left[b]
            split_a, split_b = la != a, lb != b
            # the later of the two is undone; a byte cannot be, and then the other is
            take_a = np.where(undo_a, split_a, ~split_b & split_a)
            take_b = np.where(undo_a, ~split_a & split_b, split_b)
            limit = np.where(take_a, a, np.where(take_b, b + 1, limit))
            a, b = np.where(take_a, la, a), np.where(take_b, lb, b)
            go = ~bad & (take_a | take_b)
            live, a, b, limit = live[go], a[go], b[go], limit[go]
        return ok

    def valid_one(self, a: int, b: int) -> bool:
        """valid() for one pair."""
        key = a << 20 | b
        if (v := self._valid_seen.get(key)) is None:
            if len(self._valid_seen) > 500_000:
                self._valid_seen.clear()
            v = self._valid_seen[key] = self._valid_pair(a, b)
        return v

    def _valid_pair(self, a: int, b: int) -> bool:
        limit, merged, left, right = 1 << 30, self.merged_at, self.lefts, self.rights
        while True:
            if merged.get(a << 20 | b, limit) < limit:
                return False
            la, lb = right[a], left[b]
            split_a, split_b = la != a, lb != b
            if split_a and (a > b or not split_b):
                limit, a = a, la
            elif split_b:
                limit, b = b + 1, lb
            else:
                return True

    # -- the recurrence

    def long_word(self, raw: bytes, every: bool) -> tuple[array, int]:
        """(counts at every prefix with its last byte at the word's end, or none if not every; count of the word)."""
        n = len(raw)
        # 4 bytes each for every prefix: a word may be a whole text
        last, count, out = array("i", bytes(4 * n + 4)), array("i", bytes(4 * n + 4)), array("i")
        if not n:
            return out, 0
        at, here = 0, []
        for end, token, size in self.suffixes(raw):
            if end != at:
                self._settle(at, here, last, count)
                if every and at:
                    out.append(self._last(at, raw, last, count))
                at, here = end, []
            here.append((size, token))
        self._settle(n, here, last, count)
        whole = self._last(n, raw, last, count)
        if every:
            out.append(whole)
        return out, whole

    def suffixes(self, raw: bytes) -> Iterator[tuple[int, int, int]]:
        """(end, token, its length) of all tokens in a word, by their ends."""
        return ((i + 1, t, k) for i, (t, k) in self.finder.iter(raw.decode("latin-1")))

    def _settle(self, i: int, here: list[tuple[int, int]], last: array, count: array) -> None:
        """The prefix of length i: its last token is the longest that is stable after the prefix before it."""
        if not i:
            return
        for k, t in sorted(here, reverse=True):
            if k == i or self.valid_one(last[i - k], t):
                last[i], count[i] = t, count[i - k] + 1
                return
        raise AssertionError("single bytes always fit")

    def _last(self, i: int, raw: bytes, last: array, count: array) -> int:
        """The count of the first i bytes as a word."""
        for k in self.final_lengths:
            if k <= i and (t := self.final.get(raw[i - k : i])) is not None and (k == i or self.valid_one(last[i - k], t)):
                return count[i - k] + 1
        raise AssertionError("single bytes always fit")

    def words(self, raws: list[bytes]) -> np.ndarray:
        """Token count of each word (piece)."""
        out = np.zeros(len(raws), np.int64)
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        for i in np.flatnonzero(size > _WIDE):
            out[i] = self.long_word(raws[i], False)[1]
        order = np.flatnonzero((size > 0) & (size <= _WIDE))
        order = order[np.argsort(size[order], kind="stable")]
        for some in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if order.size else []:
            for part in np.array_split(some, max(1, len(some) // 16384)):
                out[part] = self._side_by_side([raws[i] for i in part])
        return out

    def _side_by_side(self, raws: list[bytes]) -> np.ndarray:
        """As words(), for words of one length."""
        w, n = len(raws), len(raws[0])
        chars = np.frombuffer(b"".join(raws), np.uint8).reshape(w, n).T.astype(np.uint64) + np.uint64(1)
        power = np.array([pow(int(_P), k, 1 << 64) for k in range(n + 1)], np.uint64)
        prefix = np.zeros((n + 1, w), np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _P + chars[i]
        last, count = np.full((n + 1, w), -1, np.int32), np.zeros((n + 1, w), np.int32)

        def best(i: int, table: _Lookup, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
            token, number = np.full(w, -1, np.int32), np.zeros(w, np.int32)
            left = np.arange(w)
            for k in lengths:
                if k > i or not left.size:
                    continue
                t = table(prefix[i, left] - prefix[i - k, left] * power[k])
                at = np.flatnonzero(t >= 0)
                if not at.size:
                    continue
                if k < i:
                    at = at[self.valid(last[i - k, left[at]], t[at])]
                token[left[at]] = t[at]
                number[left[at]] = count[i - k, left[at]] + 1
                keep = np.ones(left.size, bool)
                keep[at] = False
                left = left[keep]
            return token, number

        for i in range(1, n):  # the whole word's last token carries the end mark
            last[i], count[i] = best(i, self.inner_table, self.inner_lengths)
        return best(n, self.final_table, self.final_lengths)[1]

    # -- texts

    def pieces(self, chunk: bytes) -> tuple[list[bytes], int]:
        """The words that BPE works on in a run without ASCII white space, and how many special tokens it holds."""
        text = chunk.decode()
        special = 0
        parts = [text]
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            special = len(parts) // 2
            parts = parts[::2]
        out: list[bytes] = []
        for p in parts:
            if self.ascii_pieces is not None and p.isascii():
                out += [x.encode() for x in self.ascii_pieces.findall(p.lower())]
            elif p:
                of = byte_letters()
                p = self.library.normalizer.normalize_str(p)
                out += [bytes(map(of.__getitem__, x)) for x, _ in self.library.pre_tokenizer.pre_tokenize_str(p)]
        return out, special

    def chunks(self, chunks: list[bytes]) -> list[int]:
        """Token counts of runs without ASCII white space: no token reaches over it."""
        cut = [self.pieces(c) for c in chunks]
        number: dict[bytes, int] = {}
        for ps, _ in cut:
            for p in ps:
                number.setdefault(p, len(number))
        counts = self.words(list(number)).tolist()
        return [s + sum(counts[number[p]] for p in ps) for ps, s in cut]

    def prefix_table(self, text: str) -> np.ndarray:
        """counts[p] is the exact token count of the first p characters of the normalised text (see normalised())."""
        text = self.normalised(text)
        out = np.zeros(len(text) + 1, np.int64)
        total, at = 0, 0
        for m in re.finditer("[^ ]+", text):
            out[at + 1 : m.start() + 1] = total
            out[m.start() + 1 : m.end() + 1] = total + self.run_table(m[0])
            total = out[m.end()]
            at = m.end()
        out[at + 1 :] = total
        return out

    def run_table(self, run: str) -> np.ndarray:
        """Token counts of the first 1, 2, ... characters of a run of normalised text without white space."""
        out = np.zeros(len(run), np.int64)
        total, done = 0, 0
        for piece, start, stop in self._spans(run):
            out[done:start] = total
            size = np.cumsum([len(c.encode()) for c in piece])
            out[start:stop] = total + np.array(self.long_word(piece.encode(), True)[0], np.int64)[size - 1]
            if piece[0] == "'" and piece[-1].isalpha():  # a contraction begun is not one yet: 'r of 're
                for k in range(2, len(piece)):
                    out[start + k - 1] = total + self.long_word(b"'", False)[1] + self.long_word(piece[1:k].encode(), False)[1]
            total, done = out[stop - 1], stop
        out[done:] = total
        return out

    def _spans(self, run: str) -> list[tuple[str, int, int]]:
        of = byte_letters()
        return [(bytes(map(of.__getitem__, x)).decode(), a, b) for x, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(run)]

    def normalised(self, text: str) -> str:
        """What the library's normaliser makes of text; prefixes are counted in its characters.

        Strings of special tokens are ordinary text in a table of prefixes.
        """
        return self.library.normalizer.normalize_str(text)

    def truncate(self, text: str, budget: int) -> tuple[str, int]:
        """(the longest prefix of the normalised text with at most budget tokens, their number).

        The counts at the ends of the runs say in which run the budget ends; only this one's own table is looked into.
        """
        text = self.normalised(text)
        runs = [m.span() for m in re.finditer("[^ ]+", text)]
        upto = np.concatenate(([0], np.cumsum(self.plain_chunks([text[a:z].encode() for a, z in runs]), dtype=np.int64)))
        k = int(np.searchsorted(upto, budget, "right")) - 1  # runs that fit whole
        if k == len(runs):
            return text, int(upto[-1])
        a, z = runs[k]
        table = upto[k] + self.run_table(text[a:z])
        within = np.flatnonzero(table <= budget)
        if not within.size:
            return text[:a], int(upto[k])
        return text[: a + int(within[-1]) + 1], int(table[within[-1]])

    def plain_chunks(self, chunks: list[bytes]) -> list[int]:
        """As chunks(), strings of special tokens being ordinary text."""
        held, self.special = self.special, None
        try:
            return self.chunks(chunks)
        finally:
            self.special = held


class CountCache(dict):
    """run without white space -> token count; emptied when full, and long runs are forgotten after their batch."""

    def __init__(self, counter: PrefixCounter, most: int = 600_000):
        super().__init__()
        self.counter, self.most, self.long = counter, most, []

    def fill(self, runs: set[bytes]) -> None:
        new = [c for c in runs if c not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(runs)
        self.update(zip(new, self.counter.chunks(new), strict=True))
        self.long = [r for r in new if len(r) > LONGEST]

    def forget(self) -> None:
        """Drops the long runs of the last fill."""
        for r in self.long:
            self.pop(r, None)


_caches: dict[str, CountCache] = {}


def _cache(path: str) -> CountCache:
    if path not in _caches:
        _caches[path] = CountCache(PrefixCounter(path))
    return _caches[path]


def _stores(raws: list[bytes], vocabulary: str) -> list[np.ndarray]:
    """Of each text the token counts at the ends of its runs: the i-th is that of the first i runs."""
    cache = _cache(vocabulary)
    runs = [r.split() for r in raws]
    cache.fill(set().union(*runs))
    out = [np.concatenate(([0], np.cumsum(np.fromiter(map(cache.__getitem__, r), np.int64, len(r))))) for r in runs]
    cache.forget()
    return out


def fits(store: np.ndarray, budget: int) -> int:
    """How many runs of a text have at most budget tokens."""
    return int(np.searchsorted(store, budget, "right")) - 1


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (<id_col>, n_bytes, n_tokens, over_limit).

    ``vocabulary`` is a file of the tokenizers library that every executor has. Null and empty texts have no tokens. Texts
    are read whole, however long. Ids are carried along row by row, null and repeated ones too; other columns are not
    read. An empty table gives an empty result.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = texts(batch, "t")
        stores = _stores(raws, vocabulary)
        over = [fits(s, limit) < len(s) - 1 for s in stores]
        return pa.record_batch([batch.column("i"), pa.array(map(len, raws), pa.int64()), pa.array([s[-1] for s in stores], pa.int64()), pa.array(over, pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def prefix_store(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (<id_col>, upto): token counts of the text up to the end of each run between white space.

    upto[0] is 0 and the last is the text's count, so budgets are answered from the stored counts: see runs_within().
    Nulls, long texts, ids and empty tables are as in count_tokens().
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        stores = _stores(texts(batch, "t"), vocabulary)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(s) for s in stores]))).astype(np.int32)), pa.array(np.concatenate(stores) if stores else np.empty(0, np.int64)))
        return pa.record_batch([batch.column("i"), lists], names=[id_col, "upto"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"`{id_col}` {kind}, upto array<bigint>")


def runs_within(upto: Column, budget: int) -> Column:
    """Of a stored table, how many runs from the text's start have at most budget tokens: no text is read."""
    return F.size(F.filter(upto, lambda x: x <= F.lit(budget))) - 1


def truncate_texts(documents: DataFrame, vocabulary: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (<id_col>, text, n_tokens): the longest prefix with at most budget tokens, and their number.

    Prefixes are those of the normalised text, in which strings of special tokens are ordinary text; the counts of all
    prefixes come out of one table, and nothing is encoded. Null and empty texts give empty ones. Long texts, ids and
    empty tables are as in count_tokens().
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _cache(vocabulary).counter
        got = [counter.truncate(t.decode(), budget) for t in texts(batch, "t")]
        return pa.record_batch([batch.column("i"), pa.array([t for t, _ in got], pa.string()), pa.array([n for _, n in got], pa.int64())], names=[id_col, "text", "n_tokens"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"`{id_col}` {kind}, text string, n_tokens bigint")
