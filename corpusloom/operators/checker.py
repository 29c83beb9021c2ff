"""Spelling and grammar issues: a pluggable checker on the executors, and native columns for all that follows.

A checker turns a text into matches: array<struct<rule_id, issue_type, offset, length>>, offsets in code points.
"""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.core.batches import parts, release
from corpusloom.core.rows import require, with_metrics
from corpusloom.functions.pytext import WHITE, token_count

MATCHES = "array<struct<rule_id: string, issue_type: string, offset: int, length: int>>"
_ARROW_MATCHES = pa.list_(pa.struct([("rule_id", pa.string()), ("issue_type", pa.string()), ("offset", pa.int32()), ("length", pa.int32())]))


class LineChecker:
    """A checker process: a JSON string a line in, a JSON object a line out, READY on its error stream when it is up."""

    def __init__(self, command: list[str], language: str = "be-BY", startup_timeout: float = 30, no_suggestions: bool = True):
        if shutil.which(command[0]) is None:
            raise FileNotFoundError(f"no such program: {command[0]}; is it installed where executors run?")
        for arg in command[1:]:
            if arg.startswith("@") and not os.path.exists(arg[1:]):
                raise FileNotFoundError(f"no such argument file: {arg[1:]}; build the checker first")
        extra = ["--stdin-loop", "--language", language, *["--no-suggestions"] * no_suggestions]
        pipe = subprocess.PIPE
        self.process = subprocess.Popen([*command, *extra], stdin=pipe, stdout=pipe, stderr=pipe, text=True, encoding="utf-8", bufsize=1)
        ready = threading.Event()
        threading.Thread(target=self._listen, args=(ready,), daemon=True).start()
        if not ready.wait(startup_timeout) or self.process.poll() is not None:
            self.close()
            raise RuntimeError(f"the checker was not ready after {startup_timeout} s")

    def _listen(self, ready: threading.Event) -> None:
        for line in self.process.stderr:
            if line.strip() == "READY":
                ready.set()
        ready.set()

    def check(self, text: str) -> dict:
        if self.process.poll() is not None:
            raise RuntimeError(f"the checker ended with code {self.process.returncode}")
        self.process.stdin.write(json.dumps(text, ensure_ascii=False) + "\n")
        self.process.stdin.flush()
        line = self.process.stdout.readline()
        if not line:
            raise RuntimeError("the checker closed its output")
        return json.loads(line)

    def close(self) -> None:
        self.process.kill()
        self.process.wait()


def read_matches(payload: dict) -> list[dict]:
    """Matches of a checker's answer; an answer without any but with an error is raised."""
    if "matches" not in payload:
        raise RuntimeError(f"checker: {payload.get('error', payload)}")
    out = []
    for m in payload["matches"]:
        rule = m.get("rule") or {}
        out.append({"rule_id": rule.get("id") or "<no-id>", "issue_type": rule.get("issueType") or "uncategorized", "offset": m.get("offset", 0), "length": m.get("length", 0)})
    return out


def checked(text: Column, client: Callable[[], object]) -> Column:
    """Matches of each text, null texts having none; ``client`` makes one client a task (with check() and close())."""

    @F.arrow_udf(MATCHES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = client()
        try:
            for batch in batches:
                for texts in parts(batch):
                    yield pa.array([[] if t is None else read_matches(one.check(t)) for t in texts.to_pylist()], _ARROW_MATCHES)
        finally:
            if hasattr(one, "close"):
                one.close()
            release()

    return run(text)


def _is_name(text: Column, m: Column) -> Column:
    """Whether a flagged word looks like a proper noun: all Latin letters, or upper case and not after a sentence's end."""
    word = F.substring(text, m["offset"] + 1, m["length"])
    before = F.regexp_replace(F.substring(text, F.lit(1), m["offset"]), f"[{WHITE}]+$", "")
    inside = (F.length(before) > 0) & ~F.substring(before, F.lit(-1), F.lit(1)).isin(".", "!", "?")
    return F.rlike(word, F.lit("^[A-Za-z]+$")) | (F.rlike(word, F.lit("^\\p{Lu}")) & inside)


def issue_metrics(
    df: DataFrame,
    matches: Column,
    input_field: str = "text",
    metric_prefix: str = "langtool",
    disabled_rules: tuple[str, ...] = (),
    exclude_proper_nouns: bool = False,
    num_words_field: str = "num_words",
    words: str | None = None,
    word_types: tuple[str, ...] = ("misspelling",),
) -> DataFrame:
    """metrics.<prefix> = {types, count, density, excluded_proper_nouns}, all native.

    The density's denominator is num_words where that is positive, else the text's tokens, and at least 1. ``words`` names
    a column of (word, rule_id) for the counted matches of word_types, words lower-cased.
    """
    require(df, input_field)
    text = F.col(f"`{input_field}`")
    found = F.filter(F.coalesce(matches, F.array().cast(MATCHES)), lambda m: ~m["rule_id"].isin(list(disabled_rules)) if disabled_rules else F.lit(True))
    df = df.withColumn("_found", found)
    name = lambda m: (m["issue_type"] == "misspelling") & _is_name(text, m) if exclude_proper_nouns else F.lit(False)
    df = df.withColumn("_kept", F.filter("_found", lambda m: ~name(m)))
    kinds = F.transform("_kept", lambda m: m["issue_type"])
    types = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)))))
    given = F.coalesce(F.col(num_words_field).cast("int"), F.lit(0)) if num_words_field in df.columns else F.lit(0)
    n_words = F.greatest(F.when(given > 0, given).otherwise(token_count(text)), F.lit(1))
    value = F.struct(types.alias("types"), F.size("_kept").alias("count"), (F.size("_kept") / n_words).alias("density"), (F.size("_found") - F.size("_kept")).alias("excluded_proper_nouns"))
    if words:
        shown = lambda m: F.struct(F.lower(F.substring(text, m["offset"] + 1, m["length"])).alias("word"), m["rule_id"].alias("rule_id"))
        df = df.withColumn(words, F.transform(F.filter("_kept", lambda m: m["issue_type"].isin(list(word_types))), shown))
    return with_metrics(df, **{metric_prefix: value}).drop("_found", "_kept")


def flagged_words(df: DataFrame, matches: Column, input_field: str = "text", issue_types: tuple[str, ...] = ("misspelling",)) -> DataFrame:
    """(word, rule_id) of every match of the issue types, words lower-cased: for most_common()."""
    text = F.col(f"`{input_field}`")
    rows = df.select(text.alias("t"), F.explode(matches).alias("m")).where(F.col("m.issue_type").isin(list(issue_types)))
    return rows.select(F.lower(F.substring("t", F.col("m.offset") + 1, F.col("m.length"))).alias("word"), "m.rule_id")
