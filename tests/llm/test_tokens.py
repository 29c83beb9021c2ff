import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import packing as P
from corpusloom.llm import prefix_counts as C
from corpusloom.llm.words import WordHashes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counter():
    return C.PrefixCounter(PATH)


def library_counts(counter, texts):
    return [len(e.ids) for e in counter.library.encode_batch(texts, add_special_tokens=False)]


ALPHABET = "abcdefghij'0123!?-é́İſɏ漢字😀 \n\x85\x1c<|endoftext|>SsTtrevl.,"
SPECIAL = ["", "Hello'RE can't''s  <|endoftext|>x <|START|>   é Å ΑΣ İx", "a" * 3000, "é" * 500 + "😀" * 50, "\x1c\x85 \x0b foo\x00bar   x'll'd'r 've"]


def test_counts_and_ids_equal_the_library(counter):
    rng = random.Random(1)
    texts = SPECIAL + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80))) for _ in range(1500)]
    runs = [t.encode().split() for t in texts]
    every = sorted(set().union(*runs))
    counts = dict(zip(every, counter.chunks(every), strict=True))
    assert [sum(map(counts.__getitem__, r)) for r in runs] == library_counts(counter, texts)
    ids = P.RunIds(PATH)
    ids.fill(set(every))
    want = [e.ids for e in counter.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b"".join(map(ids.__getitem__, r)), "<u4").tolist() for r in runs] == want


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(ALPHABET.replace("<", "").replace("|", "")), max_size=40))
def test_every_prefix_equals_the_library(counter, text):
    text = counter.normalised(text)
    got = counter.prefix_table(text)
    # a prefix of normalised text is normalised unless a mark that would compose follows its end
    prefixes = [text[:k] for k in range(len(text) + 1)]
    for k, p in enumerate(prefixes):
        if counter.normalised(p) == p:
            assert got[k] == library_counts(counter, [p])[0]


def test_truncate(counter):
    text = "internationalisation of the telecommunication can't wait"
    for budget in range(12):
        cut, n = counter.truncate(text, budget)
        assert library_counts(counter, [cut])[0] == n <= budget
        longer = [text[:k] for k in range(len(cut) + 1, len(text) + 1)]
        assert all(n > budget for n in library_counts(counter, longer) or [99])


def test_truncate_equals_trying_all_prefixes(counter):
    rng = random.Random(3)
    for _ in range(60):
        text = counter.normalised("".join(rng.choice("abcdefgh 'stre,.é") for _ in range(rng.randrange(50))))
        prefixes = [text[:k] for k in range(len(text) + 1)]
        counts = library_counts(counter, prefixes)
        if any(counter.normalised(p) != p for p in prefixes):
            continue
        for budget in range(0, max(counts) + 2, 3):
            k = max(k for k, n in enumerate(counts) if n <= budget)
            assert counter.truncate(text, budget) == (prefixes[k], counts[k])


def test_a_run_of_1_mb_without_blanks(counter):
    """Whole, in memory that grows with it; the library cuts such a run after its own length only."""
    rng = random.Random(5)
    run = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    want = len(counter.library.encode(run[:100_000], add_special_tokens=False).ids)
    assert counter.chunks([run[:100_000].encode()]) == [want]
    whole = counter.chunks([run.encode()])[0]
    assert abs(whole / 1_000_000 - want / 100_000) < 0.01 * want / 100_000
    cut, n = counter.truncate(run + " tail", 1000)
    assert library_counts(counter, [cut]) == [n] and n <= 1000 < library_counts(counter, [run[: len(cut) + 20]])[0]


def test_stored_counts_answer_budgets(spark, edge, nothing, counter):
    texts = ["the quick brown fox can't wait", "", None, "internationalisation " * 30, "x" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stores = C.prefix_store(df, PATH)
    got = {r.doc_id: (r.upto, r.k) for r in stores.select("*", C.runs_within(F.col("upto"), 7).alias("k")).collect()}
    for i, t in enumerate(texts):
        runs = (t or "").split()
        want = library_counts(counter, [" ".join(runs[:k]) for k in range(len(runs) + 1)])
        assert got[i] == (want, max(k for k, n in enumerate(want) if n <= 7))
    cut = {r.doc_id: (r.text, r.n_tokens) for r in C.truncate_texts(df, PATH, 7).collect()}
    for i, t in enumerate(texts):
        assert cut[i][1] == library_counts(counter, [cut[i][0]])[0] <= 7 and (t or "").startswith(cut[i][0])
    assert C.truncate_texts(edge, PATH, 50).count() == 10 and C.truncate_texts(nothing, PATH, 5).collect() == [] and C.prefix_store(nothing, PATH).collect() == []


def test_caches_stay_bounded(counter):
    cache, ids = C.CountCache(counter, 50), P.RunIds(PATH, 50)
    for i in range(10):
        runs = {f"word{i}x{k}".encode() for k in range(20)} | {b"the"}
        cache.fill(runs)
        ids.fill(runs)
        assert len(cache) <= 71 and len(ids) <= 71 and all(r in cache and r in ids for r in runs)
    for held in (cache, ids):
        held.fill({b"y" * 1000, b"z," * 400, "é".encode() * 300 + b"!"})
        held.forget()
        assert max(map(len, held)) <= 200
    hashes = WordHashes(9)
    for i in range(30):
        assert hashes[b"w" * i * 10] == xxhash.xxh64_intdigest(b"w" * i * 10) and len(hashes) <= 9 and max(map(len, hashes)) <= 200


def test_count_tokens_edges(edge, nothing, counter):
    got = {(str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in C.count_tokens(edge, PATH).collect()}
    want = set()
    for r in edge.collect():
        t = r.text or ""
        n = library_counts(counter, [t])[0]
        want.add((str(r.doc_id), len(t.encode()), n, n > 2048))
    assert got == want
    assert C.count_tokens(nothing, PATH).collect() == []


# -- packing


def test_plans_are_whole_and_tight():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 2048, 4000), np.clip(rng.exponential(500, 5000).astype(int), 1, 2048), np.full(700, 1024), np.array([2048, 1, 1]), rng.integers(900, 1200, 500)):
        counts = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
        plan = P.make_plan(counts, 2048)
        assert plan.used == counts
        best = sum(k for _, k in P.best_fit_counts({n: c for n, c in counts.items() if n < 2048}, 2048)) + counts.get(2048, 0)
        assert P.bound(counts, 2048) <= plan.sequences <= 1.02 * best + 1
    assert P.make_plan({}, 2048).sequences == 0


def test_nnls_solves_small_systems():
    cols = [(np.array([0]), np.array([1.0])), (np.array([0, 1]), np.array([1.0, 1.0])), (np.array([1]), np.array([-1.0]))]
    x = P.nnls(cols, np.array([5.0, 3.0]), np.ones(2))
    assert np.all(x >= 0) and abs(x[0] + x[1] - 5) < 1e-6 and abs(x[1] - x[2] - 3) < 1e-6


def check_packing(rows, docs, size, counter):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    for i, text in docs:
        ids = [*counter.library.encode(text or "", add_special_tokens=False).ids, 0]
        mine = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.start for r in mine] == list(range(0, len(ids), size)) and [r.piece for r in mine] == list(range(len(mine)))
        for r in mine:
            part = ids[r.start : r.start + r.length]
            assert r.length == len(part) and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    return len(by_seq)


def test_pack_documents(spark, counter):
    rng = random.Random(8)
    docs = [(i, " ".join(f"tok{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 5, 30, 300])))) for i in range(150)] + [(900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    for size in (64, 500):
        rows = P.pack_documents(df, PATH, size=size).collect()
        n = check_packing(rows, docs, size, counter)
        assert n <= 1.02 * -(-sum(r.length for r in rows) // size) + 1


def test_pack_edges(edge, nothing):
    rows = P.pack_documents(edge, PATH).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.length for r in rows if r.doc_id == 3) == 1 and len([r for r in rows if r.doc_id == 1]) == 2
    assert P.pack_documents(nothing, PATH).collect() == []


def test_a_length_of_many_pieces_is_numbered_in_parts(spark, counter, monkeypatch):
    monkeypatch.setattr(P, "BIN_ROWS", 3)
    docs = [(i, "same words here") for i in range(200)]
    rows = P.pack_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), PATH, size=16).collect()
    assert check_packing(rows, docs, 16, counter) == 50
