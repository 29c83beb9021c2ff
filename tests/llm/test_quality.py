import random

import pytest

from corpusloom.llm import quality as Q


def brute_repeated(words, n=3):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(n)})


def test_repeated_words_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        words = [bytes([97 + rng.randrange(rng.choice([2, 5, 20]))]) for _ in range(rng.randrange(40))]
        assert Q.repeated_words(words) == brute_repeated(words)


def test_measures():
    d = Q.Doc("a b\n\n é#$ \na b\n  \na b".encode())
    assert (d.n_words, d.word_chars, d.n_symbols, d.n_lines, d.n_dup_lines) == (7, 9, 2, 4, 2)
    assert Q.Doc(b"").n_words == Q.Doc(b"").word_chars == Q.Doc(b"").n_dup_lines == 0


def test_order_is_by_rejections_per_cost():
    measured = [("too_few_words", 1.0, 0.5), ("symbols", 0.1, 0.2), ("shouting", 0.1, 0.0)]
    assert [r.name for r in Q.order_rules(measured)] == ["symbols", "too_few_words", "shouting"]


def test_order_changes_no_verdict_and_cascade_stops(edge):
    names = [r.name for r in Q.RULES]
    runs = [Q.quality_cascade(edge, order=order).select("doc_id", "kept").collect() for order in (names, names[::-1])]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))
    seen = []
    rules = tuple(Q.Rule(n, lambda d, n=n: seen.append(n) or n == "b") for n in "abc")
    assert next(r.name for r in rules if r.rejects(None)) == "b" and seen == ["a", "b"]


def test_edges(edge, nothing):
    got = Q.quality_cascade(edge, measures=("n_words",)).collect()
    assert len(got) == 10
    kept = sorted((str(r.doc_id), r.n_words) for r in got if r.kept)
    assert kept == [("1", 80), ("1", 80), ("2", 80), ("None", 81)]  # the long text repeats its windows
    assert Q.quality_cascade(nothing).collect() == []
    assert sorted(str(r.doc_id) for r in Q.keep_passing(edge).collect()) == [k for k, _ in kept]
    assert Q.keep_passing(edge).schema == edge.schema and Q.keep_passing(nothing).collect() == []


@pytest.mark.parametrize(("text", "why"), [("### " * 60 + "a b " * 60, "symbols"), ("WORDS LOUD " + " ".join(f"LOUD{i}" for i in range(60)), "shouting")])
def test_rubbish_is_rejected(spark, text, why):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert Q.quality_cascade(df, rules=tuple(r for r in Q.RULES if r.name == why)).first().rejected_by == why
