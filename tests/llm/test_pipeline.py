import random
import zlib

import numpy as np
import pytest

import corpus_pipeline as C
from corpusloom.llm import quality as Q
from corpusloom.llm import secrets as S
from tests.llm.test_jaccard_join import brute

SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(9)
    sf_dir = str(tmp_path_factory.mktemp("sf"))
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 200))]
        if i % 9 == 0:
            words.insert(7, SECRET)
        rows.append([i, " ".join(words), "en", "big" if i % 3 else "small", 0])
    for i in range(60, 80):  # copies, exact or with one word changed
        words = rows[rng.randrange(20)][1].split(" ")
        if i % 2:
            words[-3] = f"x{i}"
        rows.append([i, " ".join(words), "en", "big", 0])
    rows += [[80, "too short", "en", "big", 0], [81, None, "en", "big", 0], [82, "### " * 80 + " ".join(f"q{k}" for k in range(60)), "en", "big", 0], [83, "same words again " * 60, "en", "big", 0]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in C.STAGES:
        got = stage(spark, docs, sf_dir)
        path = f"{sf_dir}/{name}"
        got.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((name, before.collect(), docs.collect(), docs.columns))
    return {n: (b, a, c) for n, b, a, c in out}, sf_dir


def test_stages_keep_the_columns_of_documents(stages):
    got = stages[0]
    assert list(got) == ["quality_rules", "near_duplicates", "secret_scan", "source_mix", "best_fit_packing"]
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for n, (_, _, c) in got.items() if n != "best_fit_packing")


def test_quality_rejects_by_the_rules(stages):
    before, after, _ = stages[0]["quality_rules"]
    keep = [r for r in before if not any(x.rejects(Q.Doc((r.text or "").encode())) for x in Q.RULES)]
    assert sorted(after) == sorted(keep) and {80, 81, 82, 83} & {r.doc_id for r in after} == set()


def test_one_of_each_class_stays(stages):
    before, after, _ = stages[0]["near_duplicates"]
    want = {i for i, (_, c, _) in brute([(r.doc_id, r.text) for r in before], 5, 80).items() if i == c}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_secrets_are_gone_and_documents_stay(stages):
    before, after, _ = stages[0]["secret_scan"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    old = {r.doc_id: r.text for r in before}
    for r in after:
        assert S.base_spans(r.text) == []
        assert r.text == (old[r.doc_id].replace(SECRET[:-1], "[SECRET]") if SECRET in old[r.doc_id] else old[r.doc_id])


def test_the_mix_leaves_nothing_out(stages):
    before, after, _ = stages[0]["source_mix"]
    assert {tuple(r) for r in before} == {tuple(r) for r in after}
    uses = {s: sum(len(r.text.split()) for r in after if r.source == s) / sum(len(r.text.split()) for r in before if r.source == s) for s in ("big", "small")}
    assert uses["big"] == 1.0 < uses["small"] <= 4.2


def test_all_tokens_are_packed(stages):
    from tokenizers import Tokenizer

    before, after, _ = stages[0]["best_fit_packing"]
    library = Tokenizer.from_file(C.VOCABULARY)
    want = []
    for r in before:
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 0]
        want += [(r.doc_id, k, at, zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.ids_crc32) for r in after) == sorted(want)
    ends = {}
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def test_run_is_the_stages_in_turn(stages, spark):
    got, sf_dir = stages
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, C.run(spark, sf_dir).collect())) == sorted(map(key, got["best_fit_packing"][1]))
