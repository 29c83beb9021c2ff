import hashlib
import json
import random
import sys

import pytest
from pyspark.sql import functions as F

from corpusloom.core.components import connected_components
from corpusloom.core.rows import dotted, with_metrics, with_reasons
from corpusloom.functions import pytext, stats
from corpusloom.operators import checker, dedup, rules, signals
from corpusloom.plans import catalogue


def test_python_text_functions(spark):
    texts = ["", " ", "a b", " a b\x1cc\x85", "x", None, "​z", "é😀"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    c = F.col("t")
    got = df.select(pytext.token_count(c), pytext.char_count(c), pytext.strip(c), pytext.squeeze(c)).collect()
    for t, r in zip(texts, got, strict=True):
        assert (r[0], r[1]) == (len((t or "").split()), len(t or ""))
        assert r[2] == (None if t is None else t.strip()) and r[3] == (None if t is None else " ".join(t.split()))


@pytest.mark.parametrize("n", [1, 5, 10, 100])
def test_nearest_rank(spark, n):
    values = [((i * 37) % n) / 7 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    assert stats.nearest_rank(df, "v") == {p: sorted(values)[min(int(n * p), n - 1)] for p in stats.QUANTILES}
    assert stats.nearest_rank(df.limit(0), "v") == {}


def test_most_common(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "w string")
    assert [tuple(r) for r in stats.most_common(df, "w", 2).collect()] == [("a", 2), ("b", 2)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 1), (20, 21), (30, 30), (None, 4), (21, 20)] + [(100, 100 + i) for i in range(60)] + [(200 + i, 201 + i) for i in range(25)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {n: 1 for n in (1, 2, 3, 6, 7, 8, 9)} | {20: 20, 21: 20, 30: 30} | {100 + i: 100 for i in range(60)} | {200 + i: 200 for i in range(26)}
    assert got == want


# -- rules

ROW = "id int, text string, metrics struct<score: double, keep: boolean, n: int, types: map<string,int>>, removal_reasons array<string>"


@pytest.mark.parametrize(
    ("rule", "passing"),
    [
        ({"type": "no_removal_reasons"}, [0, 2]),
        ({"type": "reject_if_reason", "reason": "b"}, [0, 1, 2]),
        ({"type": "min_metric", "key": "metrics.score", "value": 0.5}, [0]),
        ({"type": "max_metric", "key": "metrics.score", "value": 0.5}, [0, 1, 2]),
        ({"type": "min_metric", "key": "metrics.none", "value": 0}, []),
        ({"type": "max_metric", "key": "none.x", "value": 0}, [0, 1, 2, 3]),
        ({"type": "require_true", "key": "metrics.keep"}, [0]),
        ({"type": "require_true", "key": "metrics.n"}, [1]),
        ({"type": "require_true", "key": "text"}, [0, 1]),
        ({"type": "require_true", "key": "metrics.types"}, [0]),
        ({"type": "not_contains", "key": "text", "substring": "и"}, [0, 2, 3]),
        ({"type": "not_contains", "key": "metrics.n", "substring": "1"}, [0, 1, 2, 3]),
        ({"type": "min_metric", "key": "metrics.types.x", "value": 1}, [0]),
    ],
)
def test_each_rule(spark, rule, passing):
    rows = [(0, "abc", (0.5, True, 0, {"x": 1}), []), (1, "и", (0.1, False, 2, {}), ["a"]), (2, "", None, None), (3, None, (float("nan"), None, None, None), ["b", "a"])]
    df = spark.createDataFrame(rows, ROW)
    got = rules.judge(df, [{"name": "r", **rule}])
    assert sorted(r.id for r in rules.split(got)[0].collect()) == passing


def test_order_split_and_funnel(spark):
    df = spark.createDataFrame([(i, float(i), i % 2 == 0) for i in range(10)], "id int, a double, b boolean")
    spec = [{"name": "confident", "type": "min_metric", "key": "a", "value": 4}, {"name": "keeper", "type": "require_true", "key": "b"}]
    judged = rules.judge(df, spec)
    kept, lost = rules.split(judged)
    assert kept.columns == df.columns and kept.count() + lost.count() == 10
    assert {r.id: r.filtered_by for r in lost.collect()}[1] == ["confident", "keeper"]
    s = rules.statistics(judged, spec)
    assert s["per_rule_failures"] == {"confident": 4, "keeper": 5}
    assert s["funnel"] == [{"rule": "confident", "dropped": 4, "remaining_after": 6}, {"rule": "keeper", "dropped": 3, "remaining_after": 3}]
    assert rules.statistics(judged.limit(0), spec)["survival_rate"] == 0.0
    assert rules.split(rules.judge(df, []))[0].count() == 10


@pytest.mark.parametrize("bad", [[{"type": "require_true"}], [{"name": "a", "type": "x"}], [{"name": "a", "type": "no_removal_reasons"}] * 2])
def test_bad_rules(spark, bad):
    with pytest.raises(ValueError):
        rules.judge(spark.range(1), bad)


# -- signals


def test_metrics_grow_and_reasons_append(spark):
    df = spark.createDataFrame([(1,)], "id int")
    df = with_metrics(with_metrics(df, a=F.lit(1)), b=F.lit(2), a=F.lit(3))
    df = with_reasons(with_reasons(df, x=F.lit(True)), y=F.lit(None).cast("boolean"), x=F.lit(True))
    r = df.first()
    assert r.metrics.asDict() == {"b": 2, "a": 3} and r.removal_reasons == ["x", "x"]
    assert [r[0] for r in df.select(dotted(df, "metrics.c.d", "none")).distinct().collect()] == ["none"]
    assert dotted(df, "metrics.b") is not None and dotted(df, "metrics.c") is None and dotted(df, "id.x") is None


def test_length_ratio(spark):
    rows = [("a b", "a b", 1.0, 0, False), ("a b", "a b c d", 2.0, 2, False), ("a", "a b c", 3.0, 2, True), ("", "", 1.0, 0, False), ("a b c d e", "a", 0.2, 4, True), (None, "a", 1.0, 0, False)]
    df = spark.createDataFrame([r[:2] for r in rows], "src string, tgt string")
    got = [(r.src, r.tgt, r.metrics.len_ratio, r.metrics.len_diff, bool(r.removal_reasons)) for r in signals.length_ratio(df).collect()]
    assert got == rows
    assert not any(r.removal_reasons for r in signals.length_ratio(df, length_slack=4).collect())
    for bad in ({"unit": "x"}, {"length_slack": -1}):
        with pytest.raises(ValueError):
            signals.length_ratio(df, **bad)


def test_language_flags(spark):
    fake = lambda c: F.struct(F.substring(c, 1, 2).alias("label"), (F.length(c) / 10).alias("score"))
    df = spark.createDataFrame([("be long enough", "be"), ("en long enough", "be"), ("be", "be"), ("be\nlong here", None)], "text string, original_code string")
    got = [(r.metrics.glotlid_label, r.removal_reasons) for r in signals.language(df, fake).collect()]
    assert got == [("be", []), ("en", ["wrong_lang"]), ("be", ["wrong_lang"]), ("be", ["wrong_lang"])]
    two = spark.createDataFrame([("be a b c d e", "en a b c d e"), ("xx a b c d e", "en x"), ("xx a b c d e", "yy a b c d e")], "src string, tgt string")
    got = [r.removal_reasons for r in signals.pair_language(two, fake, src_lang="be", tgt_lang="en", min_words=3).collect()]
    assert got == [[], [], ["src_wrong_lang", "tgt_wrong_lang"]]


def test_quality_estimate(spark):
    df = spark.createDataFrame([("ab", "abc"), ("", None)], "src string, tgt string")
    got = signals.quality_estimate(df, lambda ts: [[len(t)] for t in ts], lambda a, b: [[x[0] + y[0]] for x, y in zip(a, b, strict=True)])
    assert [r.metrics.blaser_score for r in got.collect()] == [5.0, 0.0]
    near = signals.embedding_cosine(df, lambda ts: [[1.0, len(t)] for t in ts]).collect()
    assert near[1].metrics.sonar_cosine == 1.0


# -- checker


def test_issue_metrics(spark):
    text = "Стакгольм вялікі. Швецыя and Hister. ня Горад"
    at = lambda w: (text.index(w), len(w))
    found = [("R1", "misspelling", *at("Стакгольм")), ("R1", "misspelling", *at("Швецыя")), ("R1", "misspelling", *at("Hister")), ("R1", "misspelling", *at("Горад")), ("R2", "grammar", *at("ня")), ("OFF", "style", 0, 1)]
    df = spark.createDataFrame([(text, found, 0), (text, None, 4)], f"text string, m {checker.MATCHES}, num_words int")
    got = [r.metrics.langtool for r in checker.issue_metrics(df, F.col("m"), disabled_rules=("OFF",), exclude_proper_nouns=True).collect()]
    assert got[0].asDict() == {"types": {"misspelling": 2, "grammar": 1}, "count": 3, "density": 3 / 7, "excluded_proper_nouns": 2}
    assert got[1].asDict() == {"types": {}, "count": 0, "density": 0.0, "excluded_proper_nouns": 0}
    words = stats.most_common(checker.flagged_words(df, F.col("m")), "word", 9).collect()
    assert [r.value for r in words] == ["hister", "горад", "стакгольм", "швецыя"]


def test_answers_of_checkers():
    assert checker.read_matches({"matches": [{"rule": {"issueType": None}, "offset": 3, "length": 2}]}) == [{"rule_id": "<no-id>", "issue_type": "uncategorized", "offset": 3, "length": 2}]
    with pytest.raises(RuntimeError):
        checker.read_matches({"error": "x"})


FAKE = """
import json, sys
print("READY", file=sys.stderr, flush=True)
for line in sys.stdin:
    text = json.loads(line)
    print(json.dumps({"matches": [{"rule": {"id": "BAD", "issueType": "misspelling"}, "offset": i, "length": 3} for i in range(len(text)) if text.startswith("bad", i)]}), flush=True)
"""


def test_a_checker_process(spark, tmp_path):
    script = tmp_path / "checker.py"
    script.write_text(FAKE)
    command = [sys.executable, str(script)]
    df = spark.createDataFrame([("bad é bad",), (None,), ("good",)], "text string")
    got = checker.issue_metrics(df, checker.checked(F.col("text"), lambda: checker.LineChecker(command)))
    assert [r.metrics.langtool["count"] for r in got.collect()] == [2, 0, 0]
    with pytest.raises(FileNotFoundError):
        checker.LineChecker(["no-such-program"])
    with pytest.raises(FileNotFoundError):
        checker.LineChecker([sys.executable, "@no-such-file"])
    quiet = tmp_path / "quiet.py"
    quiet.write_text("import sys; sys.exit(3)")
    with pytest.raises(RuntimeError):
        checker.LineChecker([sys.executable, str(quiet)], startup_timeout=5)


# -- near duplicates


@pytest.mark.parametrize(("threshold", "perms", "shape"), [(0.8, 128, (9, 13)), (0.5, 64, (14, 4)), (0.7, 64, (8, 8)), (0.8, 64, (5, 11)), (0.8, 32, (3, 10))])
def test_band_shape(threshold, perms, shape):
    assert dedup.band_shape(threshold, perms) == shape


def test_dedup(spark):
    a, b = "the quick brown fox jumps over the lazy dog today", "a wholly other sentence about the weather in the north"
    rows = [(0, a), (1, a + " now"), (2, a.upper()), (3, b), (4, b + " too"), (5, "nothing like the rest of them here"), (6, "short"), (7, None)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    marked = dedup.mark_duplicates(df, threshold=0.5, ngram_size=2, num_perm=64, min_length=2)
    got = {r.id: (r.metrics.dedup_cluster_id, r.metrics.dedup_keeper) for r in marked.collect()}
    assert got == {0: (0, True), 1: (0, False), 2: (0, False), 3: (3, True), 4: (3, False), 5: (5, True), 6: (-7, True), 7: (-8, True)}
    assert dedup.statistics(marked) == {"rows_total": 8, "clusters_total": 5, "clusters_with_duplicates": 2, "rows_kept": 5, "rows_dropped": 3}
    assert dedup.mark_duplicates(df.limit(0)).count() == 0


def test_registered_dedup_equals_brute_force_minhash(spark, tmp_path):
    """The queries as registered, against minima of 128 permutations in 9 bands of 13, worked out one by one."""
    rng = random.Random(8)
    texts = []
    for i in range(24):
        words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(60)]
        texts += [" ".join(words), " ".join([*words[: -1 - i % 6], "changed", *words[len(words) - i % 6 :]])]
    texts += ["too short", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    params = list(zip(*(x.tolist() for x in dedup.permutations(128)), strict=True))
    cluster, band = list(range(48)), {}
    for i, text in enumerate(texts[:48]):
        w = text.split()
        hashes = [int(hashlib.md5(" ".join(w[k : k + 5]).encode()).hexdigest()[:8], 16) % dedup.PRIME for k in range(len(w) - 4)]
        low = [min((a * h + b) % dedup.PRIME for h in hashes) for a, b in params]
        for k in range(9):
            first = band.setdefault((k, *low[13 * k : 13 * k + 13]), i)
            old, new = max(cluster[first], cluster[i]), min(cluster[first], cluster[i])
            cluster = [new if c == old else c for c in cluster]
    want = {i: (c, c == i) for i, c in enumerate(cluster)} | {48: (-49, True), 49: (-50, True)}
    assert len(set(cluster)) < 36
    for name in ("dedup_clusters", "dedup_clusters_128"):
        assert {r.doc_id: (r.dedup_cluster_id, r.dedup_keeper) for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect()} == want
    kept = len({c for c, _ in want.values()})
    assert [tuple(r) for r in catalogue.QUERIES["dedup_statistics"](spark, str(tmp_path)).collect()] == [(50, kept, kept)]


def test_json_round_trip_of_rules():
    assert json.loads(json.dumps(sorted(rules.LIBRARY))) == sorted(rules.LIBRARY)


def test_few_texts_are_python_strings_at_once(spark):
    """Long texts are worked on some at a time, however many rows a batch has."""
    import pyarrow as pa

    from corpusloom.core.batches import PART_BYTES, over_texts, parts

    long = "é" * 100_000
    df = spark.range(60).coalesce(1).select(F.when(F.col("id") % 7 != 0, F.concat(F.lit(long), F.col("id").cast("string"))).alias("t"), "id")
    held = over_texts("struct<n: int, size: int>", lambda texts: pa.array([{"n": len(texts), "size": len(t or "")} for t in texts], pa.struct([("n", pa.int32()), ("size", pa.int32())])))
    got = df.select("id", held(F.col("t")).alias("x")).select("id", "x.*").collect()
    assert sorted(r.id for r in got) == list(range(60)) and max(r.n for r in got) < 10
    assert all(r.size == (100_000 + len(str(r.id)) if r.id % 7 else 0) for r in got)
    texts = pa.array(["a" * PART_BYTES, "b" * (PART_BYTES + 1), None, "", "c", "d" * (PART_BYTES - 1), "e"])
    assert [len(p) for p in parts(texts)] == [1, 1, 4, 1] and pa.concat_arrays(list(parts(texts.slice(1)))).equals(texts.slice(1))
    assert list(parts(texts.slice(0, 0))) == []


def test_strip_and_has_tokens(spark):
    """As Python's, and no slower for long runs of blanks inside."""
    import sys
    import time

    from corpusloom.functions.pytext import has_tokens, strip, token_count

    white = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
    texts = [white + "a" + white + "b" + white, "", " ", "x", " x ", "x y", "\u200bx y\u200b", "a\n b\u3000c", "a b c d", *[f"{c}a{c}b{c}" for c in white], "a" + " " * 200_000 + "b", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    began = time.monotonic()
    got = df.select("i", strip(F.col("t")).alias("s"), token_count(F.col("t")).alias("n"), *[has_tokens(F.col("t"), n).alias(f"h{n}") for n in range(5)]).orderBy("i").collect()
    assert time.monotonic() - began < 10
    for t, r in zip(texts, got, strict=True):
        assert r.s == (None if t is None else t.strip()) and r.n == len((t or "").split())
        assert [r[f"h{n}"] for n in range(5)] == [r.n >= n for n in range(5)]


def test_signature_equals_its_formula():
    import hashlib

    from corpusloom.operators import dedup

    a, b = dedup.permutations(128)
    for n in (1, 3, 5, 6, 400, 2000):
        words = dedup.tokens(" ".join(f"Wörd{i * i % 977}," for i in range(n)))
        assert words == [f"wörd{i * i % 977}" for i in range(n)]
        grams = {" ".join(words[i : i + 5]) for i in range(max(1, n - 4))}
        h = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % dedup.PRIME for g in grams]
        assert dedup.signature(words, 5, 128).tolist() == [min((x * y + z) % dedup.PRIME for y in h) for x, z in zip(a.tolist(), b.tolist(), strict=True)]
    assert dedup.signature([], 5, 128) is None
