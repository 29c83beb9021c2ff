"""Quality rules as a short-circuit cascade.

A rule rejects a document. The cascade estimates on a sample what each rule costs and how often it rejects, and orders
the rules by rejections per cost, so that most rejected documents meet a cheap, often rejecting rule first. A document
that a rule has rejected is not shown to the later ones. The order changes the work, never the verdicts: a document is
kept when no rule rejects it. The sample's order is the only thing that the sample sets.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches, releasing, slices, texts
from corpusloom.llm.words import SPACES

SYMBOLS = b"#*$%&|<>"


class Doc:
    """A text whose measures are worked out when a rule first asks for them."""

    __slots__ = ("_seen", "raw")

    def __init__(self, raw: bytes):
        self.raw, self._seen = raw, {}

    def __getattr__(self, name: str):
        seen = self._seen
        if name not in seen:
            seen[name] = _MEASURES[name](self)
        return seen[name]


def _lines(doc: Doc) -> tuple[int, int]:
    """Lines that have a word, and how many of them equal an earlier one."""
    full = [x for x in doc.raw.split(b"\n") if x.strip(SPACES)]
    return len(full), len(full) - len(set(full))


def _chars(raw: bytes) -> int:
    return len(raw) - int(((a := np.frombuffer(raw, np.uint8)) & 0xC0 == 0x80).sum()) if not raw.isascii() else len(raw)


def repeated_words(words: list[bytes], n: int = 3) -> int:
    """How many words lie in an n-word window that is found twice or more (all its places count)."""
    if len(words) <= n:
        return 0
    codes, unique = pd.factorize(np.array(words, object))
    key, size = codes.astype(np.int64), len(unique)
    for i in range(1, n):  # pairs, then triples: numbered anew each time, so that keys are exact and stay small
        key, unique = pd.factorize(key[:-1] * size + codes[i:])
        key = key.astype(np.int64)
        last = len(unique)
    if last == len(key):
        return 0
    twice = np.bincount(key)[key] > 1
    cover = np.zeros(len(words), bool)
    for i in range(n):
        cover[i : i + len(twice)] |= twice
    return int(cover.sum())


_MEASURES: dict[str, Callable] = {
    "words": lambda d: d.raw.split(),
    "n_words": lambda d: len(d.words),
    "word_chars": lambda d: _chars(d.raw.translate(None, SPACES)),
    "n_symbols": lambda d: len(d.raw) - len(d.raw.translate(None, SYMBOLS)),
    "lines": _lines,
    "n_lines": lambda d: d.lines[0],
    "n_dup_lines": lambda d: d.lines[1],
    "n_repeat_words": lambda d: repeated_words(d.words),
    "n_upper_words": lambda d: sum(map(bytes.isupper, d.words)),
    "n_short_lines": lambda d: sum(0 < len(x.split()) < 3 for x in d.raw.split(b"\n")),
}


@dataclass(frozen=True)
class Rule:
    """rejects(doc) is true for a document to be rejected."""

    name: str
    rejects: Callable[[Doc], bool]


#: The rules that every document must pass whatever a cascade adds.
BASE_RULES = (
    Rule("too_few_words", lambda d: d.n_words < 50),
    Rule("repeated_windows", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
#: Marks of machine-made rubbish: set well outside what prose, lists and tables of figures show.
EXTRA_RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("duplicate_lines", lambda d: 2 * d.n_dup_lines > d.n_lines),
    Rule("long_words", lambda d: d.word_chars > 18 * d.n_words),
    Rule("short_words", lambda d: 2 * d.word_chars < 3 * d.n_words),
    Rule("shouting", lambda d: 10 * d.n_upper_words > 8 * d.n_words),
)
RULES = BASE_RULES + EXTRA_RULES


def estimate(raws: list[bytes], rules: tuple[Rule, ...] = RULES, clock: Callable = time.perf_counter) -> list[tuple[str, float, float]]:
    """(name, seconds a document, share rejected) of each rule, every rule measured on fresh documents."""
    out = []
    for rule in rules:
        docs = [Doc(r) for r in raws]
        began = clock()
        hits = sum(bool(rule.rejects(d)) for d in docs)
        out.append((rule.name, (clock() - began) / max(1, len(docs)), hits / max(1, len(docs))))
    return out


def order_rules(measured: list[tuple[str, float, float]], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Most rejections per second first; ties by name."""
    by = {r.name: r for r in rules}
    return tuple(by[n] for n, cost, rate in sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[0])))


def sampled(documents: DataFrame, text_col: str, rows: int) -> list[bytes]:
    """About rows texts (never more than twice that, and of 64 KB each) for estimates, spread over the table by hash of the
    text. They set the order of rules, which changes no verdict."""
    few = documents.select(F.col(f"`{text_col}`").alias("t")).where("t is not null and octet_length(t) <= 65536")
    n = few.count()
    if n > rows:
        few = few.where(F.pmod(F.xxhash64("t"), F.lit(n)) < rows)
    # a text of many copies falls in or out as one; its copies tell nothing new
    return [r.t.encode() for r in few.limit(2 * rows).collect()]


def quality_cascade(documents: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 256, order: list[str] | None = None, measures: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: (<id_col>, *measures, kept, rejected_by).

    rejected_by is the first rule of the cascade that rejects, null for kept documents. ``order`` fixes the cascade's
    order by rule names; else it is estimated on ``sample_rows`` texts. ``measures`` names long columns to return.
    Null and empty texts have no words and are judged like any other text. Ids, null or repeated ones too, are carried
    along row by row; other columns are not read. Texts are read whole, however long. An empty table gives an empty result.
    """
    if order is None:
        rules = order_rules(estimate(sampled(documents, text_col, sample_rows), rules), rules)
    else:
        rules = tuple({r.name: r for r in rules}[n] for n in order)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs = [Doc(r) for r in texts(batch, "t")]
        by = [next((r.name for r in rules if r.rejects(d)), None) for d in docs]
        cols = [pa.array([getattr(d, m) for d in docs], pa.int64()) for m in measures]
        return pa.record_batch([batch.column("i"), *cols, pa.array([b is None for b in by]), pa.array(by, pa.string())], names=[id_col, *measures, "kept", "rejected_by"])

    kind = documents.schema[id_col].dataType.simpleString()
    return map_batches(documents, {"i": id_col, "t": text_col}, "t", work, f"`{id_col}` {kind}, " + "".join(f"{m} bigint, " for m in measures) + "kept boolean, rejected_by string")


def keep_passing(documents: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = 256) -> DataFrame:
    """The rows of documents that no rule rejects, all columns as they are, in one pass that stops at the first rejection.

    Null and empty texts have no words and are judged like any other. Texts are read whole, some megabytes at a time.
    Null ids, repeated rows and columns of any name are carried along. An empty table gives an empty result.
    """
    rules = order_rules(estimate(sampled(documents, text_col, sample_rows), rules), rules)
    at = documents.columns.index(text_col)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, text_col)):
            raws = [b"" if t is None else t for t in batch.column(at).cast(pa.binary()).to_pylist()]
            keep = [not any(r.rejects(d) for r in rules) for d in map(Doc, raws)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(releasing(run), documents.schema)
