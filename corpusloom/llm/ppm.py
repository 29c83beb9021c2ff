"""Prediction by partial matching: a byte-context trie, pretrained on the corpus, gives each text a code length.

What is scored is the sequence of a text's words (A-Z lower-cased), a blank between neighbours, and an end symbol: the
same sequence that the unigram base scores word by word.

Counting covers all training texts, and every context keeps its counts, however large the corpus. Escape estimation is
that of method D; with symbol exclusion, an escape from a context removes its symbols from the shorter ones. The
probability of a symbol then depends only on the ORDER symbols before it: it belongs to a string of ORDER + 1 symbols.

The trie is a table of these strings with their counts, and grows with the corpus. All that the contexts of a string
need, but for the two shortest, lies in strings that share the two symbols before the last: by these the table is dealt
into shards, and each works out the probabilities of its own strings. The two shortest contexts have at most 257 x 257
strings, which every shard is given.

The base needs the count of every word, and these grow with the corpus. Texts are dealt into blocks of bounded size,
and only the distinct words of a block, by 64-bit hash, travel to their counts and back. Strings of symbols travel with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut, drop, new_path
from corpusloom.llm.batches import slices, texts
from corpusloom.llm.words import WordHashes

ORDER = 5
#: Context symbols before the last one by which strings are dealt into shards; strings in a shard, about.
SHARED, SHARD_GRAMS = 2, 1 << 17
#: The end of a text; contexts before its start are ends, too.
END = 256
_BITS = 9
#: Bytes of text in a block, about: what it asks for grows less than its text.
BLOCK_BYTES = 24 << 20
#: Bytes of text whose symbols are worked on together: each takes some 60 bytes meanwhile.
STEP_BYTES = 1 << 19


def symbols(raws: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, each after ``order`` ends and closed by one; where each text's first own symbol is)."""
    joined = [b" ".join(r.lower().split()) for r in raws]
    size = np.fromiter(map(len, joined), np.int64, len(joined))
    first = np.cumsum(size + 1 + order) - (size + 1)
    out = np.full(int((size + 1 + order).sum()), END, np.uint16)
    flat = np.frombuffer(b"".join(joined), np.uint8)
    out[np.arange(len(flat)) + np.repeat(first - (np.cumsum(size) - size), size)] = flat
    return out, first


def keys(stream: np.ndarray, first: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The symbol strings of order + 1 symbols as numbers, one for each own symbol of the texts."""
    key = np.zeros(len(stream) - order, np.int64)
    for i in range(order + 1):
        key = key << _BITS | stream[i : len(stream) - order + i].astype(np.int64)
    # the string that ends at i starts at i - order; a text's padding is not its own
    pad = np.zeros(len(stream), bool)
    for i in range(order):
        pad[first - 1 - i] = True
    return key[~pad[order:]]


def grams(stream: np.ndarray, first: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(distinct symbol strings of order + 1 symbols as numbers, counts)."""
    return np.unique(keys(stream, first, order), return_counts=True)


class Level(NamedTuple):
    """Strings of a context and a symbol after it, for contexts of one length.

    weight: the string's count less a half, 0 where not seen; kept and escape: the weights of all symbols after its
    context, and what is left for others. after: log10 of the symbol once the context is escaped from, its own symbols
    excluded; log10: of the symbol after the context.
    """

    key: np.ndarray
    weight: np.ndarray
    kept: np.ndarray
    escape: np.ndarray
    after: np.ndarray
    log10: np.ndarray


def level(gram: np.ndarray, n: np.ndarray, length: int, below: Level | None) -> Level:
    """The level of contexts of a length; ``below`` is that of the next shorter ones, with all their strings.

    gram and n have every string that shares a context of this length, also those only asked for, which count 0.
    """
    key, at = np.unique(gram & ((1 << _BITS * (length + 1)) - 1), return_inverse=True)
    count = np.bincount(at, n, len(key))
    weight = np.where(count > 0, count - 0.5, 0.0)
    ctx = np.unique(key >> _BITS, return_inverse=True)[1]
    kept = np.bincount(ctx, weight)[ctx]
    escape = np.maximum(np.bincount(ctx, count)[ctx] - kept, 1e-300)
    if below is None:
        others = END + 1 - int((weight > 0).sum())  # symbols not seen anywhere
        after = np.full(len(key), -np.log10(max(others, 1)))
        if not others:
            escape[:] = 1e-300
    else:
        up = np.searchsorted(below.key, key & ((1 << _BITS * length) - 1))
        gone = np.bincount(ctx, np.where(weight > 0, below.weight[up], 0))[ctx]
        rest = np.log10(below.kept[up] - gone + below.escape[up])
        with np.errstate(divide="ignore"):
            after = np.where(below.weight[up] > 0, np.log10(below.weight[up]), np.log10(below.escape[up]) + below.after[up]) - rest
    with np.errstate(divide="ignore"):
        log10 = np.where(weight > 0, np.log10(weight), np.log10(escape) + after) - np.log10(kept + escape)
    # a context without symbols is none: its suffix stands for it
    return Level(key, weight, kept, escape, after, log10 if below is None else np.where(kept > 0, log10, below.log10[up]))


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, log10) for each row (gram, n): its last symbol's log10 probability after the others. A gram has one row."""
    shared = min(SHARED, order)
    mask = F.lit((1 << _BITS * shared) - 1)
    low: Level | None = None
    if shared:
        # at most 257 x 257 rows: strings of two symbols
        short = counts.groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("n").alias("n")).toPandas()
        for k in range(shared):
            low = level(short["gram"].to_numpy(np.int64), short["n"].to_numpy(np.int64), k, low)
    held = counts.sparkSession.sparkContext.broadcast(low)
    shards = max(1, -(-counts.count() // SHARD_GRAMS))

    def score(table: pa.Table) -> pa.Table:
        gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
        now = held.value
        for k in range(shared, order + 1):
            now = level(gram, n, k, now)
        return pa.table([now.key, now.log10.astype(np.float32)], names=["gram", "log10"])

    dealt = counts.withColumn("shard", F.pmod(F.xxhash64(F.shiftright("gram", _BITS).bitwiseAND(mask)), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(score, "gram bigint, log10 float")


def block_names(spark: SparkSession, blocks: int) -> DataFrame:
    """(nth, blk): a name for each block, so that dealing blocks by hash of their names gives each task one of them."""
    at = F.pmod(F.hash("blk"), F.lit(blocks))
    tried = spark.range(16 * blocks).select(F.col("id").cast("int").alias("blk")).groupBy(at.alias("nth")).agg(F.min("blk").alias("blk"))
    # a block for which none is found has one beyond those tried, wherever it lies
    every = spark.range(blocks).select(F.col("id").cast("int").alias("nth"))
    return every.join(tried, "nth", "left").select("nth", F.coalesce("blk", F.lit(16 * blocks) + F.col("nth")).alias("blk"))


def _words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


_hashes: WordHashes | None = None


def _word_hashes(raw: bytes) -> np.ndarray:
    global _hashes
    if _hashes is None:
        _hashes = WordHashes()
    w = _words(raw)
    return np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w)).view(np.int64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sums of their counts) of lists of keys with counts."""
    key, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(at, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


def score_texts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, order: int = ORDER) -> DataFrame:
    """One row per document: (<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the documents for which held_out is false. score is the model's log10 probability of the text's words,
    A-Z lower-cased, with a blank between neighbours, and of its end: what the base scores, too. Null and empty texts are
    one end token. A null held_out counts as false. Ids, null or repeated ones too, are carried along row by row, and equal
    texts have equal scores; other columns are not read. Texts are read whole, however long. An empty table gives an
    empty result. Where nothing
    is left to learn from, base_score is 0 tokens' worth of smoothing: log10(0.5 / 0.5) = 0 a token, and score that of
    symbols all alike.
    """
    spark = documents.sparkSession
    out = F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False))
    docs = documents.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"), out.alias("h"))
    size, ends = docs.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)), F.count_if(~F.col("h"))).first()
    blocks = max(1, -(-size // BLOCK_BYTES))

    # blocks by hash of id and text; a row's length evens out over them
    dealt = docs.withColumn("nth", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int"))
    dealt = dealt.join(F.broadcast(block_names(spark, blocks)), "nth").select("i", "t", "h", "blk").repartition(blocks, "blk")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}

        def add(block: int, word: bool, key: np.ndarray, n: np.ndarray) -> None:
            parts = held.setdefault((block, word), [])
            parts.append(_summed([(key, n)]))
            if sum(len(k) for k, _ in parts[1:]) > max(250_000, len(parts[0][0]) // 2):
                parts[:] = [_summed(parts)]

        for whole in batches:
            for batch in slices(whole, "t", STEP_BYTES):
                blk = batch.column("blk").to_numpy()
                learn = ~batch.column("h").to_numpy(zero_copy_only=False)
                raws = texts(batch, "t")
                words = [_word_hashes(r) for r in raws]
                for block in np.unique(blk).tolist():
                    own = np.flatnonzero(blk == block)
                    add(block, True, np.concatenate([words[i] for i in own]), np.repeat(learn[own], [len(words[i]) for i in own]).astype(np.int64))
                    for train in (False, True):
                        if some := [raws[i] for i in own if learn[i] == train]:
                            key, n = grams(*symbols(some, order), order)
                            add(block, False, key, n if train else np.zeros(len(key), np.int64))
        for block, word in list(held):
            key, n = _summed(held.pop((block, word)))
            yield pa.record_batch([pa.array(np.full(len(key), block, np.int32)), pa.array(np.full(len(key), word)), pa.array(key), pa.array(n)], names=["blk", "word", "key", "n"])

    at = new_path(spark, "asked")
    dealt.mapInArrow(count, "blk int, word boolean, key bigint, n bigint").write.parquet(at)
    asked = spark.read.schema("blk int, word boolean, key bigint, n bigint").parquet(at)

    # a word has one row a block at most, however often it is used
    by = Window.partitionBy("key")
    words = cut(asked.where("word").select("blk", "key", "n", F.sum("n").over(by).alias("c"), (F.min("blk").over(by) == F.col("blk")).alias("once")), "words")
    known = words.agg(F.sum("n"), F.count_if(F.col("once") & (F.col("c") > 0))).first()
    n_train = int((known[0] or 0) + ends)
    distinct = int((known[1] or 0) + (ends > 0))
    smooth = np.log10(n_train + 0.5 * (distinct + 1))

    strings = asked.where("not word").select("blk", F.col("key").alias("gram"), "n")
    counts = cut(strings.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    codes = cut(strings.select("blk", "gram").join(gram_scores(counts, order), "gram"), "codes")
    drop(spark, at)
    answers = words.select("blk", F.lit(True).alias("word"), "key", F.col("c").cast("double").alias("value"))
    answers = answers.unionAll(codes.select("blk", F.lit(False), "gram", F.col("log10").cast("double")))

    def score(_, left: pa.Table, right: pa.Table) -> pa.Table:
        is_word = right.column("word").to_numpy()
        key, value = right.column("key").to_numpy(), right.column("value").to_numpy()

        def answer(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.flatnonzero(rows)
            at = at[np.argsort(key[at])]
            return key[at], value[at]

        (word, c), (gram, log10) = answer(is_word), answer(~is_word)
        del key, value, is_word, right
        cost = np.log10(c + 0.5)
        end = np.log10(ends + 0.5) - smooth
        ids, held, tokens, seen, base, ppm = [], [], [], [], [], []
        for whole in left.combine_chunks().to_batches():
            for batch in slices(whole, "t", STEP_BYTES):
                raws = texts(batch, "t")
                for r in raws:
                    at = np.searchsorted(word, _word_hashes(r))
                    tokens.append(len(at) + 1)
                    seen.append(int((c[at] > 0).sum()) + (ends > 0))
                    base.append(float((cost[at] - smooth).sum() + end))
                stream, first = symbols(raws, order)
                own, back = np.unique(keys(stream, first, order), return_inverse=True)
                flat = log10[np.searchsorted(gram, own)][back]
                starts = first - order * np.arange(1, len(first) + 1)
                # each text is summed by itself, so that its score does not depend on its neighbours
                ppm += [float(flat[a:b].sum()) for a, b in zip(starts, [*starts[1:], len(flat)], strict=True)]
                ids.append(batch.column("i"))
                held.append(batch.column("h"))
        n = len(tokens)
        cols = [pa.concat_arrays(ids) if ids else left.column("i").combine_chunks(), pa.concat_arrays(held) if held else pa.array([], pa.bool_()), pa.array(tokens, pa.int64()), pa.array(seen, pa.int64()), pa.array([n_train] * n, pa.int64()), pa.array(base, pa.float64()), pa.array(ppm, pa.float64())]
        pa.default_memory_pool().release_unused()
        return pa.table(cols, names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return dealt.groupBy("blk").cogroup(answers.groupBy("blk")).applyInArrow(score, schema)
