"""Text cleaners over one string column, as Arrow-batched functions where no native expression has their meaning.

All share one contract: a changed text goes to ``output_field``, by default the input column itself; with a column of
its own, rows that do not change keep null there. Null texts stay null.
"""

from __future__ import annotations

import codecs
import html
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.core.batches import over_texts
from corpusloom.core.rows import require
from corpusloom.operators import wikitext
from corpusloom.operators.citations import strip_citations


def put(df: DataFrame, input_field: str, output_field: str | None, cleaned: Column, flag: str | None = None) -> DataFrame:
    """Write a cleaned column by the shared contract; ``flag`` names a boolean column of whether the text changed."""
    require(df, input_field)
    out = output_field or input_field
    old = F.col(f"`{input_field}`")
    df = df.withColumn("_clean", cleaned)
    changed = F.coalesce(F.col("_clean") != old, F.lit(False))
    if flag:
        df = df.withColumn(flag, changed)
    had = F.col(f"`{out}`") if out in df.columns else F.lit(None).cast("string")
    return df.withColumn(out, F.when(changed, F.col("_clean")).otherwise(old if out == input_field else had)).drop("_clean")


def batched(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """fn over batches of texts; null stays null."""
    return over_texts("string", lambda texts: pa.array([None if t is None else fn(t) for t in texts], pa.string()))


# -- Unicode compatibility form


def nfkc(text: str) -> str:
    """NFKC without combining marks that did not compose."""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKC", text) if not unicodedata.combining(c))


# -- mojibake and other damage

_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_ESCAPE = re.compile("\x1b\\[[0-9;]*[A-Za-z]")
_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f⁪-⁯﻿￹-￼]")
_BREAKS = re.compile("\r\n|[\r\x85  ]")
_SINGLE, _DOUBLE = re.compile("[ʼ‘-‛]"), re.compile("[“-‟]")
# Latin ligatures and digraph letters.
_LIGATURES = {"Ĳ": "IJ", "ĳ": "ij", "ŉ": "ʼn", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st"}
_LIGATURE = re.compile("[" + "".join(_LIGATURES) + "]")


def _sloppy(codec: str) -> dict[int, int]:
    """character -> byte of a one-byte code page; bytes that it leaves open stand for the control of their number."""
    out = {}
    for b in range(256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(ord(c), b)
    return out


_PAGES = {"latin-1": {b: b for b in range(256)}, "windows-1252": _sloppy("cp1252"), "windows-1251": _sloppy("cp1251"), "windows-1250": _sloppy("cp1250"), "macroman": _sloppy("mac_roman")}


def _span(page: dict[int, int], low: int, high: int) -> str:
    return "[" + "".join(re.escape(chr(c)) for c, b in page.items() if low <= b <= high) + "]"


def _utf8_in(page: dict[int, int]) -> re.Pattern:
    """A character of UTF-8 of two bytes or more, as it looks in a code page."""
    trail = _span(page, 0x80, 0xBF)
    return re.compile(f"{_span(page, 0xC2, 0xDF)}{trail}|{_span(page, 0xE0, 0xEF)}{trail}{{2}}|{_span(page, 0xF0, 0xF4)}{trail}{{3}}")


def _runs(page: dict[int, int]) -> tuple[re.Pattern, re.Pattern]:
    """(what every text with such characters has, runs of them); the first is searched for much faster."""
    return re.compile(_span(page, 0xC2, 0xF4) + _span(page, 0x80, 0xBF)), re.compile(f"(?:{_utf8_in(page).pattern})+")


_UTF8_RUNS = {name: _runs(page) for name, page in _PAGES.items()}
_PARTS = {b: b for b in range(0x80, 0xA0)} | _PAGES["windows-1252"]
_UTF8_PARTS = _utf8_in(_PARTS)
_MAYBE_PARTS, _RUNS_PARTS = _runs(_PARTS)
# Bytes that begin most characters of UTF-8: Latin, Greek, Cyrillic, Hebrew, Arabic, punctuation.
_COMMON = frozenset(b"\xc2\xc3\xc4\xc5\xce\xd0\xd1\xd7\xd8\xd9\xe2")


def _telling(run: str, page: dict[int, int]) -> bool:
    """Whether a run of characters of UTF-8, as they look in a code page, is a sign of damage. Letters and punctuation
    alone stand in good texts too (Èéé in macroman, Úžas or ß” in windows-1252), unless there are three characters or one
    begins as most damage does."""
    n = 0
    for c in run:
        b, kind = page[ord(c)], unicodedata.category(c)
        n += b >= 0xC2
        if (b in _COMMON and kind != "Pd") or (kind[0] not in "LPZ" and kind != "Cf"):
            return True
    return n > 2


def _reread(text: str) -> tuple[str, str] | None:
    """(text, code page) if the whole text is UTF-8 that was read in that code page, and most runs of it are telling: all
    of them in the pages that can be read in parts."""
    for name, page in _PAGES.items():
        maybe, runs = _UTF8_RUNS[name]
        if not maybe.search(text):
            continue
        told = [_telling(m[0], page) for m in runs.finditer(text)]
        if 2 * sum(told) <= len(told) or (name in ("latin-1", "windows-1252") and not all(told)):
            continue
        try:
            return codecs.charmap_encode(text, "strict", page)[0].decode("utf-8"), name
        except UnicodeError:
            continue
    return None


def _reread_parts(text: str) -> str:
    """Characters of windows-1252, or C1 controls, that are UTF-8, read anew, in a text that is not so as a whole."""

    def new(m: re.Match) -> str:
        try:
            return bytes(_PARTS[ord(c)] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    if not _MAYBE_PARTS.search(text):
        return text
    return _RUNS_PARTS.sub(lambda m: _UTF8_PARTS.sub(new, m[0]) if _telling(m[0], _PARTS) else m[0], text)


def repair(text: str) -> tuple[str, list[str]]:
    """(repaired text, kinds of the steps taken): a documented subset of what mojibake repair libraries do.

    In order: HTML entities (unless the text has ``<``), terminal escapes, UTF-8 that was read in a one-byte code page
    (whole text or parts), C1 controls, ligatures, full-width forms, curly quotes, line breaks, control characters, NFC.
    """
    if text.isascii() and "&" not in text and "\x1b" not in text and "\r" not in text and not _CONTROL.search(text):
        return text, []
    steps: list[str] = []

    def step(kind: str, new: str) -> None:
        nonlocal text
        if new != text:
            text = new
            steps.append(kind)

    if "<" not in text:
        step("apply", _ENTITY.sub(lambda m: html.unescape(m[0]), text))
    step("apply", _ESCAPE.sub("", text))
    # each turn makes the text shorter, so this ends
    while not text.isascii():
        if got := _reread(text):
            text = got[0]
            steps += ["encode", "decode"]
        elif (new := _reread_parts(text)) != text:
            step("apply", new)
        else:
            break
    step("transcode", re.sub("[\x80-\x9f]", lambda m: m[0].encode("latin-1").decode("cp1252", "ignore") or m[0], text) if re.search("[\x80-\x84\x86-\x9f]", text) else text)
    step("apply", _LIGATURE.sub(lambda m: _LIGATURES[m[0]], text))
    step("apply", re.sub("[！-￮　]", lambda m: unicodedata.normalize("NFKC", m[0]), text))
    step("apply", _DOUBLE.sub('"', _SINGLE.sub("'", text)))
    step("apply", _BREAKS.sub("\n", text))
    step("apply", _CONTROL.sub("", text))
    step("normalize", unicodedata.normalize("NFC", text))
    return text, steps


def repair_columns(text: Column) -> Column:
    """struct<text, kinds>."""

    def work(texts: list[str | None]) -> pa.Array:
        got = [(None, []) if t is None else repair(t) for t in texts]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.string()))], ["text", "kinds"])

    return over_texts("struct<text: string, kinds: array<string>>", work)(text)


# -- stages over a DataFrame


def clean_citations(df: DataFrame, input_field: str = "text", output_field: str | None = None, flag: str | None = None) -> DataFrame:
    return put(df, input_field, output_field, strip_citations(F.col(f"`{input_field}`")), flag)


def clean_nfkc(df: DataFrame, input_field: str = "text", output_field: str | None = None, flag: str | None = None) -> DataFrame:
    return put(df, input_field, output_field, batched(nfkc)(F.col(f"`{input_field}`")), flag)


def clean_mojibake(df: DataFrame, input_field: str = "text", output_field: str | None = None, flag: str | None = None, kinds: str | None = None) -> DataFrame:
    """``kinds`` names a map column: how often each kind of step changed the text."""
    require(df, input_field)
    df = df.withColumn("_made", repair_columns(F.col(f"`{input_field}`")))
    if kinds:
        steps = F.col("_made.kinds")
        df = df.withColumn(kinds, F.map_from_entries(F.transform(F.array_distinct(steps), lambda k: F.struct(k, F.size(F.filter(steps, lambda x: x == k))))))
    return put(df, input_field, output_field, F.col("_made.text"), flag).drop("_made")


def clean_wiki_markup(df: DataFrame, input_field: str = "text", output_field: str | None = None, flag: str | None = None) -> DataFrame:
    return put(df, input_field, output_field, batched(wikitext.clean)(F.col(f"`{input_field}`")), flag)
