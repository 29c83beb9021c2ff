import collections
import random

import numpy as np
import pytest

from corpusloom.core import components
from corpusloom.llm import jaccard_join as J


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    """{id: (n_shingles, component_id, n_links)} of (id, text) rows with distinct ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = dict.fromkeys(sets, 0)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i), links[i]) for i in ids}


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        words[at] = f"x{rng.randrange(10**6)}"
    return words


def corpus(seed, groups=12, copies=14):
    rng = random.Random(seed)
    out = ["", None, " \n\t ", "one", "ONE", "one two", "one two three", "a b c d", "A b C d"]
    shared = [f"s{i}" for i in range(60)]
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 9, 15, 40, 90, 300]))]
        if rng.random() < 0.5:
            base += shared
        for _ in range(copies):
            out.append(" ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, len(base) // 25 + 1]))))
    return list(enumerate(out))


def result(spark, rows, n, percent):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.jaccard_classes(df, n, percent).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_equals_brute_force(spark, n, percent):
    rows = corpus(n)
    assert result(spark, rows, n, percent) == brute(rows, n, percent)


def test_large_clusters_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(components, "MOST", 3)
    monkeypatch.setattr(components, "HOT", 20)
    monkeypatch.setattr(J, "BLOCK_SETS", 5)
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 700)
    rows = corpus(7, 6, 40)
    assert result(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_no_task_takes_two_workers(spark, monkeypatch):
    kind, chained = type(spark.range(1)), []
    plain = kind.mapInArrow

    def watched(self, *args, **more):
        same_stage = self._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
        chained.append("MapInArrow" in same_stage)
        return plain(self, *args, **more)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    monkeypatch.setattr(J, "BLOCK_SETS", 5)  # large clusters, to be parted
    rows = corpus(3, 3, 14)
    assert result(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert len(chained) > 5 and not any(chained)


def test_signatures_never_miss_a_link():
    rng = random.Random(5)
    for percent in (80, 90):
        sizes = J.Sizes(percent)
        for _ in range(1500):
            m = rng.randrange(1, 60)
            pool = np.array([rng.getrandbits(64) for _ in range(2 * m + 4)], np.uint64)
            a = np.unique(pool[:m])
            b = np.unique(np.concatenate([pool[rng.randrange(0, m // 6 + 1) : m], pool[m : m + rng.randrange(0, m // 6 + 2)]]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter >= percent * (len(a) + len(b) - inter):
                assert np.intersect1d(J.signatures(a, sizes), J.signatures(b, sizes)).size


def test_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, 1, "x"), (5, text, 2, None), (5, text, 2, None), (9, text, None, "y"), (3, None, 0, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node bigint, component_id string")
    got = sorted(map(tuple, J.jaccard_classes(df, 3, 90).collect()), key=str)
    assert got == sorted([(None, 28, None, 0), (5, 28, 5, 2), (5, 28, 5, 2), (9, 28, 5, 2), (3, 0, 3, 0)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert J.jaccard_classes(df).collect() == []


def test_sets_that_end_no_cut_send_their_shingles(monkeypatch):
    monkeypatch.setattr(J, "TURNS", 1)
    rng = random.Random(8)
    short = 0
    for percent in (80, 90):
        sizes = J.Sizes(percent)
        for _ in range(600):
            m = rng.randrange(1, 40)
            pool = np.array([rng.getrandbits(64) for _ in range(m + 4)], np.uint64)
            a, b = np.unique(pool[:m]), np.unique(pool[rng.randrange(0, m // 6 + 1) : m + rng.randrange(0, m // 6 + 1)])
            inter = len(np.intersect1d(a, b))
            if inter and 100 * inter >= percent * (len(a) + len(b) - inter):
                x, y = J.signatures(a, sizes), J.signatures(b, sizes)
                short += len(x) > len(a)
                assert np.intersect1d(x, y).size
    assert short > 50


def test_prefixes_never_miss_a_link():
    rng = random.Random(6)
    counts = np.array([rng.randrange(9) for _ in range(64)])
    for percent in (80, 90):
        for _ in range(800):
            m = rng.randrange(1, 200)
            pool = np.array([rng.getrandbits(64) for _ in range(2 * m + 4)], np.uint64)
            a = np.unique(pool[:m])
            b = np.unique(np.concatenate([pool[rng.randrange(0, m // 7 + 1) : m], pool[m : m + rng.randrange(0, m // 7 + 2)]]))
            inter = len(np.intersect1d(a, b))
            if inter and 100 * inter >= percent * (len(a) + len(b) - inter):
                assert np.intersect1d(J.prefix(a, counts, percent), J.prefix(b, counts, percent)).size


def test_overlaps_equal_intersections(monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 7)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(np.arange(1, 90, dtype=np.uint64), rng.integers(1, 60))) for _ in range(40)]
    sets += [np.unique(rng.choice(np.arange(1000, 4000, dtype=np.uint64), 300)) for _ in range(20)]
    got = J.overlaps(sets)
    assert all(got[i, k] == len(np.intersect1d(sets[i], sets[k])) for i in range(60) for k in range(60) if i != k)


def test_a_large_cluster_with_a_shared_passage(spark, monkeypatch):
    """5,000 sets that are mostly one passage: rare shingles part them, and no set moves to all blocks."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(150)]
    texts = []
    while len(texts) < 5000:
        own = [f"w{rng.randrange(10**6)}" for _ in range(30)]
        texts += [" ".join(edited(rng, own, k) + passage) for k in rng.choices((0, 1, 2, 3), k=rng.choice((1, 1, 2, 4)))]
    texts = texts[:5000]
    units, large = [], []
    dealt, parted = J._dealt, J._parted
    monkeypatch.setattr(J, "_parted", lambda docs, m, *rest: large.append(m.count()) or parted(docs, m, *rest))
    monkeypatch.setattr(J, "_dealt", lambda *a: units.append(dealt(*a)) or units[-1])
    got = result(spark, list(enumerate(texts)), 3, 90)
    sets = [shingles(t, 3) for t in texts]
    common = sorted(shingles(" ".join(passage), 3))
    held = np.array([[g in s for g in common] for s in sets], np.float32)
    rest, where = collections.Counter(), collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s.difference(common):
            for k in where[g]:
                rest[k, i] += 1
            where[g].append(i)
    low, links = list(range(5000)), [0] * 5000
    pairs = [(k, i) for (k, i), c in sorted(rest.items()) if 100 * (x := c + int(held[k] @ held[i])) >= 90 * (len(sets[k]) + len(sets[i]) - x)]
    for k, i in pairs:
        links[k] += 1
        links[i] += 1
        a, b = sorted((low[k], low[i]))
        low = [a if c == b else c for c in low]
    assert len(pairs) > 500 and len(units) == 1 and large[0] > 4000
    assert got == {i: (len(sets[i]), low[i], links[i]) for i in range(5000)}
    assert units[0].count() < 2 * 5000


def test_keep_one(spark, edge, nothing, monkeypatch):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (5, text), (5, text), (9, text), (3, None), (2, text + " x"), (7, "other words"), (7, "other words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted([(None, text), (2, text + " x"), (3, None), (7, "other words")], key=str)
    assert sorted(map(tuple, J.keep_one(df).collect()), key=str) == want
    monkeypatch.setattr(J, "FILTER_WORDS", 1)  # a filter that clears nearly none
    assert sorted(map(tuple, J.keep_one(df).collect()), key=str) == want
    monkeypatch.undo()
    assert J.keep_one(edge).schema == edge.schema and J.keep_one(nothing).collect() == []


def test_keep_one_loses_no_text_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    keep = lambda rows: sorted(map(tuple, J.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(2)).collect()), key=str)
    # one id with two texts, and another text
    assert keep([(5, a, "x"), (5, b, "x"), (6, c, "y")]) == sorted([(5, a, "x"), (5, b, "x"), (6, c, "y")], key=str)
    # one of the texts is a copy of a smaller id's
    assert keep([(5, a, "x"), (5, b, "x"), (3, a, "y")]) == sorted([(3, a, "y"), (5, b, "x")], key=str)
    # near copies under one id, a repeated row, a row without words, a row without id
    rows = [(5, a, "x"), (5, a + " z", "x"), (5, b, "x"), (5, b, "x"), (5, " ", "x"), (5, None, None), (None, a, "x")]
    got = keep(rows)
    assert len(got) == 5 and [g for g in got if g[0] == 5 and g[1] in (a, a + " z")].__len__() == 1
    assert all(r in got for r in [(5, b, "x"), (5, " ", "x"), (5, None, None), (None, a, "x")])
    # one id and set in other columns: always the same of them
    rows = [(1, a, "x"), (1, a.upper(), "y"), (1, a, None), (1, a, "x")]
    one = keep(rows)
    assert len(one) == 1 and one == keep(rows[::-1])
