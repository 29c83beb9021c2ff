"""Belarusian typography for plain text: letters, spelling, lexicon, symbols, dashes, hard blanks, quotes.

Steps run in a fixed order. A text without Cyrillic cannot match the spelling rules or the lexicon, and a rule whose
required letters are missing is not tried.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.core.batches import over_texts
from corpusloom.core.rows import require
from corpusloom.operators.cleaners import put
from corpusloom.operators.spelling_table import SPELLING

NB = "\u00a0"
_CYRILLIC = re.compile("[а-яА-ЯёЁўЎіІ]")

# Latin letters and the Cyrillic ones that look the same.
LOOKALIKES = dict(zip("aceiopxyABCEHIKMOPTXY", "асеіорхуАВСЕНІКМОРТХУ", strict=True))

# Symbol rules.
SYMBOLS = [
    ("[\u00ad\u200e\u200f]+", "", 0),
    ("([\\wа-яА-ЯёЁўЎіІ])['ʼ]([\\wа-яА-ЯёЁўЎіІ])", r"\1’\2", 0),
    ("&copy;", "©", re.I),
    ("&reg;", "®", re.I),
    ("&sect;", "§", re.I),
    ("&euro;", "€", re.I),
    ("&yen;", "¥", re.I),
    ("&pound;", "£", re.I),
    ("&deg;", "°", 0),
    (r"\(tm\)|&trade;", "™", re.I),
    (r"\.\.\.|&hellip;", "…", 0),
    (r"\+-(?!\+|-)|&plusmn;", "±", 0),
    ("~=", "≈", 0),
    ("&((la|ra|bd|ld)quo|quot);", '"', 0),
    ("<sup>2</sup>|&sup2;", "²", re.I),
    ("<sup>3</sup>|&sup3;", "³", re.I),
    (r"\^2(\D)", r"²\1", 0),
    (r"\^3(\D)", r"³\1", 0),
    (r"<<(\S.+?\S)>>", r'"\1"', 0),
    ("№№", "№", 0),
    (r"[ \t]+(\r?\n)", r"\1", 0),
]

# Dash rules.
DASHES = [
    ("–", "-", 0),
    (r"(\s)-{1,3} ", r"\1— ", 0),
    (r"(\d)--(\d)", r"\1—\2", 0),
    (r"(\s)-(\d)", r"\1−\2", 0),
    (r"(sup>|sub>|\s)-(\d)", r"\1−\2", 0),
]

# Rules for hard blanks and what stands around them.
HARD_BLANKS = [
    (r"([(\s])([12]?\d{3})[\u00a0 ]?(?:-{1,3}|—) ?([12]?\d{3})(?![\w-])", r"\1\2—\3", 0),
    (r"([12]?\d{3}) ?(гг?\.)", rf"\1{NB}\2", 0),
    (r"([(\s])([IVX]{1,5})[\u00a0 ]?(?:-{1,3}|—) ?([IVX]{1,5})(?![\w-])", r"\1\2—\3", 0),
    (r"([IVX]{1,5}) ?(стст?\.)", rf"\1{NB}\2", 0),
    (rf'(\d)[\u00a0 ]?(млн|млрд|трлн|(?:м|с|д|к)?м|[км]г)\.?(?=[,;.]| "?[а-яёўі-])', rf"\1{NB}\2", 0),
    (r"(\d)[\u00a0 ](тыс)([^\.А-Яа-яЁёЎўІі])", rf"\1{NB}\2.\3", 0),
    (r"ISBN:\s?(?=[\d\-]{8,17})", "ISBN ", 0),
    (rf"([А-ЯЁЎІ]\.) ?([А-ЯЁЎІ]\.) ?([А-ЯЁЎІ][а-яёўі])", rf"\1{NB}\2{NB}\3", 0),
    (rf"([А-ЯЁЎІ]\.)([А-ЯЁЎІ]\.)", r"\1 \2", 0),
    (rf"([а-яёўі]\.)([А-ЯA-ZЁЎІ])", r"\1 \2", 0),
    (r'([)"а-яa-zёўі\]])\s*,([\[("а-яa-zёўі])', r"\1, \2", 0),
    (r'([)"а-яa-zёўі\]])\s([,;])\s([\[("а-яa-zёўі])', r"\1\2 \3", 0),
    (r"([^%/\w]\d+?(?:[.,]\d+?)?) ?([%‰])(?!-[А-Яа-яЁёЎўІі])", rf"\1{NB}\2", 0),
    (r"(\d) ([%‰])(?=-[А-Яа-яЁёЎўІі])", r"\1\2", 0),
    (r"([№§])\s*(\d)", rf"\1{NB}\2", 0),
    (r"\( +", "(", 0),
    (r" +\)", ")", 0),
    ("([\\s\\d=≈≠≤≥<>—(\"'|])([+±−-]?\\d+?(?:[.,]\\d+?)?)(?:[ °^*]|[\u00a0 ][°^*])[CС](?=[\\s\"').,;!?|])", rf"\1\2{NB}°C", 0),
    ("([\\s\\d=≈≠≤≥<>—(\"'|])([+±−-]?\\d+?(?:[.,]\\d+?)?)(?:[ °^*]|[\u00a0 ][°^*])F(?=[\\s\"').,;|!?])", rf"\1\2{NB}°F", 0),
    (r"(\s\d+)\.(\d+[\u00a0 ]*[%‰°])", r"\1,\2", 0),
]

# The last rule of all.
BLANKS = [("[ \\t\u00a0]{2,}", " ", 0)]

_CAPITALS, _SMALL = frozenset(map(chr, [*range(0x410, 0x430), *map(ord, "ЁЎІ")])), frozenset(map(chr, [*range(0x430, 0x450), *map(ord, "ёўі")]))
_OPENING = "[\\[(\"а-яa-zёўі]"

#: What a text must have for a rule of a group, by its place, to match: one of some strings, one of some characters, or a
#: match of a pattern that is searched for faster.
NEEDS: dict[str, dict[int, list[tuple[str, ...] | frozenset | re.Pattern]]] = {
    "core": {
        0: [frozenset("\u00ad\u200e\u200f")], 1: [frozenset("'ʼ")], **{i: [frozenset("&")] for i in (*range(2, 9), 13)}, 9: [frozenset("(&"), frozenset(");")],
        10: [("...", "&hellip;")], 11: [("+-", "&plusmn;")], 12: [("~=",)], 14: [frozenset("<&")], 15: [frozenset("<&")], 16: [("^2",)], 17: [("^3",)], 18: [("<<",), (">>",)],
        19: [("№№",)], 20: [frozenset("\n"), (" \n", "\t\n", " \r\n", "\t\r\n")],
    },
    "dashes": {0: [frozenset("–")], 1: [("- ",)], 2: [("--",)], 3: [frozenset("-")], 4: [frozenset("-")]},
    "nbsp": {
        0: [frozenset("-—")], 1: [("г.",)], 2: [frozenset("-—"), frozenset("IVX")], 3: [("стс",)], 4: [frozenset("мгт"), ("м", "г", "трлн")], 5: [("тыс",)],
        6: [("ISBN:",)], 7: [_CAPITALS], 8: [_CAPITALS], 9: [_SMALL], 10: [re.compile("," + _OPENING)], 11: [re.compile(r"[,;](?<=\s.)\s")], 12: [frozenset("%‰")],
        13: [(" %", " ‰")], 14: [frozenset("№§")], 15: [("( ",)], 16: [(" )",)], 17: [re.compile(r"[CС](?<=[ °^*].)(?=[\s\"').,;!?|])")],
        18: [re.compile(r"F(?<=[ °^*].)(?=[\s\"').,;|!?])")], 19: [frozenset("%‰°")],
    },
}

#: A few pairs of the older and the present spelling; give ``lexicon`` a file of key=value lines for a whole list.
STARTER = {"сьвет": "свет", "сьнег": "снег", "песьня": "песня", "пасьля": "пасля", "есьць": "есць", "дасьць": "дасць", "радасьць": "радасць", "пытаньне": "пытанне", "жыцьцё": "жыццё", "вясельле": "вяселле"}


def load_lexicon(path: str) -> dict[str, str]:
    """key=value lines; blank lines, comments (#), lines without =, and pairs that change nothing are passed over."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no lexicon at {path}")
    pairs = {}
    with open(path, encoding="utf-8") as lines:
        for line in map(str.strip, lines):
            key, sign, value = (p.strip() for p in line.partition("="))
            if sign and key and value and key != value and not line.startswith("#"):
                pairs[key] = value
    if not pairs:
        raise RuntimeError(f"no pairs in the lexicon {path}")
    return pairs


#: Parts of a pattern that stand for more than one string of characters.
_VARIABLE = re.compile(r"\(\?=.*\)$|\\.|\[[^\]]*\][?+*]?|\([^()]*\)[?+*]?|.[?*]|[()|]")


def needle_of(pattern: str) -> str:
    """The longest string that each match of a spelling pattern contains."""
    return max(_VARIABLE.split(pattern), key=len)


@lru_cache(1)
def spelling_rules() -> list[tuple[re.Pattern, str, str]]:
    """(pattern, replacement, letters that must occur)."""
    return [(re.compile(pattern), new, needle_of(pattern)) for pattern, new in SPELLING]


@lru_cache(1)
def _spelling() -> list[tuple[re.Pattern, str, str, frozenset]]:
    """spelling_rules(), with the letters one by one."""
    return [(*rule, frozenset(rule[2])) for rule in spelling_rules()]


@lru_cache(8)
def _compiled(name: str) -> list[tuple[re.Pattern, str, list]]:
    rules = {"core": SYMBOLS, "dashes": DASHES, "nbsp": HARD_BLANKS, "collapse": BLANKS}[name]
    return [(re.compile(p, flags), new, NEEDS.get(name, {}).get(i, [])) for i, (p, new, flags) in enumerate(rules)]


def _may_match(text: str, chars: set[str], needs: list) -> bool:
    """Whether a text of those characters, or fewer, has what a rule needs."""
    for need in needs:
        if isinstance(need, frozenset):
            if chars.isdisjoint(need):
                return False
        elif isinstance(need, tuple):
            if not any(x in text for x in need):
                return False
        elif not need.search(text):
            return False
    return True


class Lexicon:
    """Whole-word replacements in one pass, the longest key first, keeping an upper-case beginning."""

    def __init__(self, pairs: dict[str, str]):
        self.pairs = pairs
        self.pattern = re.compile(r"\b(?:" + "|".join(re.escape(k) for k in sorted(pairs, key=len, reverse=True)) + r")\b", re.IGNORECASE)

    def apply(self, text: str, fires: Counter) -> str:
        def new(m: re.Match) -> str:
            key = m[0].lower()
            value = self.pairs.get(key)
            if value is None:  # matched by case folding alone
                return m[0]
            fires[f"replacements[{key}]"] += 1
            return value[0].upper() + value[1:] if m[0][0].isupper() and value[0].islower() else value

        return self.pattern.sub(new, text)


def _group(text: str, name: str, fires: Counter, chars: set[str]) -> str:
    """The text by a group's rules; characters that they add are added to chars."""
    for i, (pattern, new, needs) in enumerate(_compiled(name)):
        if _may_match(text, chars, needs) and (got := pattern.sub(new, text)) != text:
            fires[f"{name}[{i}]"] += 1
            text = got
            chars.update(new)
    return text


_LONE = "".join(LOOKALIKES)
#: A lone letter that looks Cyrillic, or a word with a Cyrillic letter.
_MIXED = re.compile(rf"(?<![\w'’ʼ])(?:[{_LONE}](?![\w'’ʼ])|(?:[^\Wа-яА-ЯёЁўЎіІ]++|['’ʼ])*+[а-яА-ЯёЁўЎіІ][\w'’ʼ]*+)")


def fix_lookalikes(text: str, cyrillic: bool) -> str:
    """Latin letters that look Cyrillic, in words with Cyrillic letters and, in a Cyrillic text, as words of one letter."""
    return _MIXED.sub(lambda m: "".join(LOOKALIKES.get(c, c) for c in m[0]), text) if cyrillic else text


_QUOTE = re.compile("[«»“”„]")
_PAIR = re.compile("([\\xa0\\s\\x02!|#'\"/(;+\\-])\"([^\"]*)([^\\s\"(|])\"([^a-zA-Zа-яА-ЯёіўЁІ0-9])")
_INNER = re.compile("«([^»]*)«([^»]*)»")


def pair_quotes(text: str) -> str:
    """All quotation marks as straight ones, then paired: outer «», inner „“."""
    text = _QUOTE.sub('"', text)
    if '"' not in text:
        return text
    for _ in range(2):
        text = _PAIR.sub(r"\1«\2\3»\4", text)
    for _ in range(len(text)):
        new = _INNER.sub("«\\1„\\2“", text)
        if new == text:
            break
        text = new
    return text


def clean(text: str, lexicon: Lexicon | None = None, typos: bool = True, dashes: bool = True, nbsp: bool = True, quotes: bool = True) -> tuple[str, dict[str, int]]:
    """(text, how often each rule fired)."""
    fires: Counter = Counter()
    cyrillic = bool(_CYRILLIC.search(text))
    new = fix_lookalikes(text, cyrillic)
    if new != text:
        fires["homoglyph"] += 1
        text = new
    chars = set(text)
    if typos and cyrillic:
        for i, (pattern, new, needle, letters) in enumerate(_spelling()):
            if letters <= chars and needle in text and (got := pattern.sub(new, text)) != text:
                fires[f"typos[{i}]"] += 1
                text = got
                chars.update(new)
    if lexicon is not None and cyrillic:
        text = lexicon.apply(text, fires)
        chars.update(text)
    text = _group(text, "core", fires, chars)
    if dashes:
        text = _group(text, "dashes", fires, chars)
    if nbsp:
        text = _group(text, "nbsp", fires, chars)
    if quotes and (new := pair_quotes(text)) != text:
        fires["quotes"] += 1
        text = new
    return _group(text, "collapse", fires, chars), dict(fires)


def typography_columns(text: Column, lexicon: dict[str, str] | None = None, **switches: bool) -> Column:
    """struct<text, fires: map<string, int>>; lexicon None is the starter list, an empty one none."""
    pairs = STARTER if lexicon is None else lexicon
    held: dict[str, Lexicon | None] = {}

    def work(texts: list[str | None]) -> pa.Array:
        if "lexicon" not in held:
            held["lexicon"] = Lexicon(pairs) if pairs else None
        got = [(None, {}) if t is None else clean(t, held["lexicon"], **switches) for t in texts]
        fires = pa.array([list(g[1].items()) for g in got], pa.map_(pa.string(), pa.int32()))
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), fires], ["text", "fires"])

    return over_texts("struct<text: string, fires: map<string,int>>", work)(text)


def clean_typography(
    df: DataFrame,
    input_field: str = "text",
    output_field: str | None = None,
    apply_typos: bool = True,
    apply_replacements: bool = True,
    apply_dashes: bool = True,
    apply_nbsp: bool = True,
    apply_quotes: bool = True,
    lexicon: str | None = None,
    flag: str | None = None,
    fires: str | None = None,
) -> DataFrame:
    """``lexicon`` is the path of a file of replacements; ``fires`` names a map column: how often each rule fired."""
    require(df, input_field)
    pairs: dict[str, str] | None = load_lexicon(lexicon) if lexicon else None
    cleaned: Callable = typography_columns(F.col(f"`{input_field}`"), pairs if apply_replacements else {}, typos=apply_typos, dashes=apply_dashes, nbsp=apply_nbsp, quotes=apply_quotes)
    df = df.withColumn("_made", cleaned)
    if fires:
        df = df.withColumn(fires, F.col("_made.fires"))
    return put(df, input_field, output_field, F.col("_made.text"), flag).drop("_made")


def rule_fires(df: DataFrame, input_field: str = "text", lexicon: dict[str, str] | None = None, **switches: bool) -> DataFrame:
    """(rule, n): how often each rule fired over all rows."""
    fires = df.select(F.explode(typography_columns(F.col(f"`{input_field}`"), lexicon, **switches)["fires"]).alias("rule", "k"))
    return fires.groupBy("rule").agg(F.sum("k").alias("n"))
