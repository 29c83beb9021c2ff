"""Inline citation and cleanup tags, removed with one native regular expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.pytext import WHITE

# The tags that are removed.
TAGS = (
    "citation needed", "better source needed", "verification needed", "failed verification", "not in citation given",
    "unreliable source?", "self-published source?", "self-published inline", "predatory source?",
    "third-party source needed", "non-primary source needed", "primary source inline", "user-generated source?",
    "clarification needed", "clarify", "explain", "elaborate", "further explanation needed", "definition needed",
    "example needed", "vague", "ambiguous", "who?", "whom?", "what?", "when?", "where?", "why?", "how?", "which?",
    "dubious – discuss", "dubious", "discuss", "disputed – discuss", "according to whom?", "by whom?",
    "neutrality disputed", "POV statement", "editorializing", "weasel words", "peacock prose", "original research?",
    "synthesis?", "opinion", "tone", "loaded language", "page needed", "year needed", "volume needed", "season needed",
    "episode needed", "time needed", "date missing", "title missing", "chapter needed", "quote needed",
    "context needed", "contradictory", "non sequitur", "relevant?", "off-topic?", "anachronism", "incomprehensible",
)


def pattern(tags: tuple[str, ...] = TAGS) -> str:
    """A Java pattern: one blank before, if any, then a bracket with a tag, 1 to 3 digits, a letter, or a numbered note."""
    blank = f"[{WHITE}]"
    words = "|".join(re.sub(r"([?.\\-])", r"\\\1", t) for t in tags)
    inner = rf"(?:{words})|\p{{Nd}}{{1,3}}|[a-z]|note{blank}+\p{{Nd}}+|n{blank}+\p{{Nd}}+"
    return rf"(?iu) ?\[{blank}*(?:{inner}){blank}*\]"


def strip_citations(text: Column) -> Column:
    return F.regexp_replace(text, pattern(), "")
