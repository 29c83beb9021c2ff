"""Text functions with the meaning that Python's str methods give them, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's str counts as white space, for a Java character class.
WHITE = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: The same characters one by one.
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def token_count(text: Column) -> Column:
    """len(text.split()); null has no tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("int")


def has_tokens(text: Column, n: int) -> Column:
    """token_count(text) >= n, reading no further than the n-th token."""
    if n <= 0:
        return F.lit(True)
    return F.coalesce(F.rlike(text, F.lit(f"^[{WHITE}]*+(?:[^{WHITE}]++[{WHITE}]++){{{n - 1}}}[^{WHITE}]")), F.lit(False))


def char_count(text: Column) -> Column:
    """len(text) in code points; null has none."""
    return F.coalesce(F.length(text), F.lit(0))


def strip(text: Column) -> Column:
    """text.strip()."""
    return F.btrim(text, F.lit(_WHITE))


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(text, f"[{WHITE}]+", " "))
