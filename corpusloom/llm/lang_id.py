"""Language identification with hyperdimensional profiles.

Each character has a random vector of +1 and -1, drawn from its code point. A trigram is bound out of the vectors of
its characters, each permuted (rotated) by its place; a document bundles (adds) the vectors of its trigrams, and a
language bundles those of its documents, each scaled to one length. A document's language is the prototype of the
largest cosine.

Letters are lower-cased; runs of other characters count as one blank. Prototypes are sums of integers, so that they do
not depend on the order in which tasks end. What is gathered is one vector a language, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import slices

DIMENSIONS = 1024
SEED = 20240229
#: Characters whose trigrams are bundled together.
STEP_CHARS = 1 << 20
#: Fixed point of a document's scaled vector.
SCALE = 1 << 20
#: More "languages" than this are no language column.
MOST_LANGUAGES = 20_000
UNKNOWN = "und"

_letter: np.ndarray | None = None
_vectors: dict[int, np.ndarray] = {}


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def char_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    if code not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        _vectors[code] = (np.random.Generator(np.random.Philox(key=SEED, counter=[code, 0, 0, 0])).integers(0, 2, dimensions, np.int8) * 2 - 1).astype(np.int8)
    return _vectors[code]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigram number) of every trigram, the trigrams' code points, and whether a document has a letter."""
    is_letter = letters()
    codes = np.frombuffer("".join(f" {t.lower()} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), size)
    alpha = is_letter[codes]
    has = np.bincount(owner[alpha], minlength=len(texts)) > 0
    codes = np.where(alpha, codes, 32)
    blank = codes == 32
    keep = ~(blank & np.concatenate(([False], blank[:-1] & (owner[1:] == owner[:-1]))))
    codes, owner = codes[keep], owner[keep]
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    c, a = number[codes], len(alphabet)
    tri = (c[:-2] * a + c[1:-1]) * a + c[2:]
    # a blank stands at both ends of every document, so none of its own trigrams is lost where documents meet
    same = owner[:-2] == owner[2:]
    tri, owner = tri[same], owner[:-2][same]
    if a**3 <= 1 << 23:
        there = np.zeros(a**3, bool)
        there[tri] = True
        unique = np.flatnonzero(there)
        place = np.zeros(a**3, np.int64)
        place[unique] = np.arange(len(unique))
        tri = place[tri]
    else:
        unique, tri = np.unique(tri, return_inverse=True)
    points = np.stack([alphabet[unique // (a * a)], alphabet[unique // a % a], alphabet[unique % a]]) if len(unique) else np.empty((3, 0), np.int64)
    return owner, tri, points, has


def bundle(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, has letters) of some texts."""
    owner, tri, points, has = trigrams(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    u = points.shape[1]
    if not u:
        return out, has
    codes = np.unique(points)
    table = np.stack([char_vector(int(c), dimensions) for c in codes])
    turned = [np.roll(table, 2 - k, axis=1) for k in range(3)]
    at = np.searchsorted(codes, points)
    for lo in range(0, u, 16384):
        hi = min(u, lo + 16384)
        bound = (turned[0][at[0, lo:hi]] * turned[1][at[1, lo:hi]] * turned[2][at[2, lo:hi]]).astype(np.float32)
        here = (tri >= lo) & (tri < hi) if u > 16384 else slice(None)
        n = np.bincount(owner[here] * (hi - lo) + tri[here] - lo, minlength=len(texts) * (hi - lo))
        out += n.reshape(len(texts), hi - lo).astype(np.float32) @ bound
    return out, has


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "t", STEP_CHARS):
        for at in range(0, part.num_rows, 256):
            yield part.slice(at, 256)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return vectors / np.maximum(norm, 1e-12)[:, None]


def train(documents: DataFrame, text_col: str, lang_col: str) -> dict[str, np.ndarray]:
    """A prototype for each non-null language of documents with letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in _steps(whole):
                vectors, has = bundle(batch.column("t").to_pylist())
                fixed = np.rint(_scaled(vectors) * SCALE).astype(np.int64)
                lang = np.array(batch.column("l").to_pylist(), object)
                for one in set(lang[has]):
                    got = fixed[has & (lang == one)].sum(axis=0)
                    sums[one] = sums[one] + got if one in sums else got
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    rows = documents.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l")).where("t is not null and l is not null")
    parts = rows.mapInArrow(run, "lang string, v array<bigint>").select("lang", F.posexplode("v").alias("at", "x"))
    sums = parts.groupBy("lang", "at").agg(F.sum("x").alias("x"))
    # one row a language
    got = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values")
    return {r.lang: np.array([p.x for p in r.v], np.float64) for r in got}


def predict(documents: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", more: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: (<id_col>, *more, lang_pred, score); score is the cosine, from 0 to 1.

    ``und`` and 0 where the text is null or has no letter, or where no language was learned. Ties go to the first
    language by name. Ids, null or repeated ones too, are carried along row by row.
    """
    names = sorted(prototypes)
    held = documents.sparkSession.sparkContext.broadcast(_scaled(np.stack([prototypes[n] for n in names])).T.astype(np.float32) if names else None)
    extra = list(more or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _steps(whole):
                vectors, has = bundle([t or "" for t in batch.column("t").to_pylist()])
                if names:
                    cosine = _scaled(vectors).astype(np.float32) @ held.value
                    best = cosine.argmax(axis=1)
                    score = np.where(has, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0).astype(np.float64)
                    lang = [names[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
                else:
                    score, lang = np.zeros(len(has)), [UNKNOWN] * len(has)
                yield pa.record_batch([batch.column("i"), *[batch.column(f"x{k}") for k in range(len(extra))], pa.array(lang, pa.string()), pa.array(score)], names=[id_col, *extra, "lang_pred", "score"])

    read = documents.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), *[c.alias(f"x{k}") for k, c in enumerate((more or {}).values())])
    kinds = dict(read.dtypes)
    schema = [f"`{id_col}` {kinds['i']}", *[f"`{n}` {kinds[f'x{k}']}" for k, n in enumerate(extra)], "lang_pred string", "score double"]
    return read.mapInArrow(run, ", ".join(schema))


def identify(documents: DataFrame, learn_where: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", more: dict[str, Column] | None = None) -> DataFrame:
    """Learn from the documents of learn_where, and predict all: (<id_col>, *more, lang_pred, score), one row per document.

    A language is any non-null value of lang_col; rows without one teach nothing, and null learn_where counts as false. No
    prediction reads lang_col. Texts are read whole, however long; null and empty ones, and those without a letter, are
    ``und`` with 0. Ties go to the first language by name; equal texts, repeated rows too, are answered alike. Other
    columns are not read. An empty table gives an empty result. More than MOST_LANGUAGES languages are an error.
    """
    return predict(documents, train(documents.where(learn_where), text_col, lang_col), id_col, text_col, more)
