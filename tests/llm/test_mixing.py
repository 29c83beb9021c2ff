import collections
import hashlib
import math

import pytest

from corpusloom.llm import mixing as M


def docs(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (i * 7) % 13)), source))
            i += 1
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)


def brute_exponent(shares, entropy_share, max_repeats, factor):
    ent = lambda a: (lambda w: -sum(x / sum(w) * math.log(x / sum(w)) for x in w))([p**a for p in shares])

    def rep(a):
        w = [p**a for p in shares]
        return max(x / sum(w) * factor / p for x, p in zip(w, shares, strict=True))

    def bisect(ok):
        low, high = 0.0, 1.0
        if ok(high):
            return high
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if ok(mid) else (low, mid)
        return low

    a = 0.0
    if entropy_share is not None:
        want = ent(1) + entropy_share * (ent(0) - ent(1))
        a = bisect(lambda x: ent(x) >= want)
    if max_repeats is not None and rep(0) > max_repeats:
        a = max(a, bisect(lambda x: rep(x) > max_repeats))
    return a


@pytest.mark.parametrize(("entropy_share", "max_repeats", "factor"), [(0.5, None, 1.0), (0.9, None, 2.0), (None, 3.0, 1.0), (0.8, 2.0, 1.5), (None, None, 1.0)])
def test_exponent_equals_brute_force(spark, entropy_share, max_repeats, factor):
    rows, df = docs(spark, {"a": 300, "b": 60, "c": 9})
    tokens = collections.Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    total = sum(tokens.values())
    sources = M.source_tokens(df, "source", "text")
    got = M.solve_exponent(sources, total, entropy_share, max_repeats, math.floor(total * factor))
    exact = math.floor(total * factor) / total
    assert abs(got - brute_exponent([v / total for v in tokens.values()], entropy_share, max_repeats, exact)) < 1e-6


def brute_mix(rows, a, factor, seed, block_rows):
    """Uses by (id, epoch) of distinct rows, walking through blocks and documents one by one."""
    by = collections.defaultdict(list)
    for i, t, s in rows:
        by[s].append((i, len(t.split()), hashlib.md5(f"{seed}|{i}|{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()))
    tokens = {s: sum(n for _, n, _ in d) for s, d in by.items()}
    total = sum(tokens.values())
    budget = math.floor(total * factor)
    z = sum((v / total) ** a for v in tokens.values())
    out = collections.Counter()
    for s, d in by.items():
        share = math.floor((tokens[s] / total) ** a / z * M.PARTS + 0.5)
        target = share * budget // M.PARTS
        blocks = -(-len(d) // block_rows)
        turn = lambda k: (hashlib.md5(f"{seed}|{s}|{k}".encode()).hexdigest(), k)  # noqa: B023, E731
        walk = sorted(d, key=lambda x: (turn(int(x[2][:8], 16) % blocks), x[2], x[0]))  # noqa: B023
        at = 0
        for i, n, _ in walk:
            for e in range(target // tokens[s] + (at < target % tokens[s])):
                out[(i, e)] += 1
            at += n
    return out


def test_uses_equal_brute_force(spark):
    rows, df = docs(spark, {"a": 200, "b": 40, "c": 5})
    got = M.mix_sources(df, 1.3, entropy_share=0.7, max_repeats=None, seed=5, block_rows=16).collect()
    sources = M.source_tokens(df, "source", "text")
    total = sources.agg({"tokens": "sum"}).first()[0]
    a = M.solve_exponent(sources, total, 0.7, None, math.floor(total * 1.3))
    assert collections.Counter((r.doc_id, r.epoch) for r in got) == brute_mix(rows, a, 1.3, 5, 16)


def test_whole_mix_leaves_nothing_out(spark):
    rows, df = docs(spark, {"a": 200, "b": 40, "c": 5})
    got = M.mix_sources(df, None, entropy_share=0.5, max_repeats=4.0, keep=True)
    uses = collections.Counter(r.doc_id for r in got.collect())
    assert set(uses) == {r[0] for r in rows} and max(uses.values()) <= 5
    assert got.columns == df.columns
    assert all(uses[r[0]] == 1 for r in rows if r[2] == "a")


def test_edges(edge, nothing):
    got = M.mix_sources(edge, None, keep=True)
    assert got.columns == edge.columns
    have = collections.Counter(str(r) for r in edge.collect())
    out = collections.Counter(str(r) for r in got.collect())
    assert set(out) == set(have) and all(out[r] >= have[r] for r in have)
    plain = M.mix_sources(edge, 1.0, entropy_share=None, max_repeats=1.0).collect()
    assert sum(r.n_tokens == 0 for r in plain) == 4
    assert M.mix_sources(nothing).collect() == [] and M.mix_sources(nothing, None, keep=True).collect() == []


def test_no_python_on_the_main_path(spark):
    _, df = docs(spark, {"a": 20, "b": 5})
    plan = M.mix_sources(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
