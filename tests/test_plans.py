import json

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import cli, pipeline
from corpusloom.plans.config import load_config
from corpusloom.sources import readers, writers
from corpusloom.streaming import apply as streaming


def lines(path):
    return sorted((json.loads(x) for p in path.glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()), key=str)


def test_config(tmp_path, monkeypatch):
    path = tmp_path / "c.yaml"
    path.write_text("input: data/${NAME_A}.jsonl\nn: $NAME_B\n")
    with pytest.raises(KeyError, match=r"NAME_A.*NAME_B"):
        load_config(str(path))
    monkeypatch.setenv("NAME_A", "x")
    monkeypatch.setenv("NAME_B", "5")
    assert load_config(str(path)) == {"input": "data/x.jsonl", "n": 5}


def test_tab_separated_pairs(spark, tmp_path):
    path = tmp_path / "pairs.tsv"
    path.write_text("﻿1\ta b c\t2\td e f\n\n3\ta b\t4\td e f\n5\ta\n6\ta b c\t7\td e f\tx\ty\n8\t a b c \t9\td e f g\n", encoding="utf-8")
    rows = readers.read_pairs(spark, str(path), src_lang="bel", tgt_lang="eng")
    assert readers.counters(rows) == {"read": 5, "malformed": 2, "too_short": 1, "written": 2}
    assert [tuple(r) for r in readers.written(rows).orderBy("src_id").collect()] == [(1, "a b c", 2, "d e f", "bel", "eng"), (8, " a b c ", 9, "d e f g", "bel", "eng")]
    bad = readers.written(readers.parse_pairs(spark.createDataFrame([("x\ta b c\t2\td e f",)], "value string")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_aligned_files(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("﻿ one two three \n\nx y\nlast one here\n", encoding="utf-8")
    b.write_text("eins zwei drei\nvier\nx y z\nein letztes hier\n", encoding="utf-8")
    rows = readers.read_aligned(spark, str(a), str(b))
    assert readers.counters(rows) == {"read": 4, "malformed": 1, "too_short": 1, "written": 2}
    assert [(r.src, r.tgt) for r in readers.written(rows).orderBy("n").collect()] == [("one two three", "eins zwei drei"), ("last one here", "ein letztes hier")]
    b.write_text("one\n")
    for pair in ((a, b), (b, a)):
        with pytest.raises(ValueError, match="line count mismatch"):
            readers.read_aligned(spark, *map(str, pair))


def test_export(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "x", (0.5, {"k": 2})), (2, None, None)], "id int, src string, metrics struct<a: double, t: map<string,int>>")
    out = writers.export(df, str(tmp_path / "p"), ["id", "metrics.a", "metrics.t.k", "none", "id"])
    assert out["columns"] == ["id", "metrics.a", "metrics.t.k", "none"] and out["rows_written"] == 2 and out["output_bytes"] > 0 and out["processing_time_s"] > 0
    assert "more than once" in capsys.readouterr().err
    back = spark.read.parquet(str(tmp_path / "p"))
    assert [tuple(r) for r in back.orderBy("id").collect()] == [(1, 0.5, 2, None), (2, None, None, None)]
    writers.export(df, str(tmp_path / "j"), ["id", "src"], "jsonl")
    assert lines(tmp_path / "j") == [{"id": 1, "src": "x"}, {"id": 2, "src": None}]
    for bad in ({"format": "csv", "columns": ["id"]}, {"columns": []}):
        with pytest.raises(ValueError):
            writers.export(df, str(tmp_path / "x"), **bad)


def test_pipeline_and_statistics(spark):
    fake = lambda c: F.struct(F.lit("bel").alias("label"), F.lit(0.9).alias("score"))
    df = spark.createDataFrame([(1, "a [1] b", "c d"), (2, "ﬁ", "x y z w"), (3, None, None)], "id int, src string, tgt string")
    stages = pipeline.build(
        [{"name": "citations", "input_field": "src"}, {"name": "nfkc", "input_field": "src"}, {"name": "length_ratio"}, {"name": "bi_glotlid", "predict": fake, "src_lang": "bel", "tgt_lang": "eng"}]
    )
    done, s = pipeline.run(df, stages)
    rows = {r.id: r for r in done.collect()}
    assert rows[1].src == "a b" and rows[2].src == "fi" and rows[3].src is None
    assert rows[2].removal_reasons == ["len_ratio_out_of_bounds", "tgt_wrong_lang"] and set(done.columns) == {"id", "src", "tgt", "metrics", "removal_reasons"}
    assert s["citations_src"]["rows_changed"] == 1 and s["nfkc_src"]["rows_total"] == 3 and s["length_ratio"]["rows_flagged"] == 1
    assert s["length_ratio"]["len_ratio_quantiles"]["p50"] == 1.0 and s["bi_glotlid"]["tgt_label_totals"] == {"bel": 3}
    with pytest.raises(ValueError, match="Unknown stage: x"):
        pipeline.build([{"name": "x"}])
    with pytest.raises(ValueError):
        pipeline.build([{"name": "languagetool"}])
    with pytest.raises(NotImplementedError):
        pipeline.build([{"name": "sonar_cosine"}], pipeline.NEURAL)


def test_statistics_of_stages(spark):
    class Bars:
        """A checker for tests: bars are typography, words of capital letters are misspelt."""

        def check(self, text):
            import re

            kinds = lambda m: {"id": "BAR", "issueType": "typographical"} if m[0] == "|" else {"id": "LOUD", "issueType": "misspelling"}
            return {"matches": [{"rule": kinds(m), "offset": m.start(), "length": len(m[0])} for m in re.finditer(r"\||[A-Z]{3,}", text)]}

    df = spark.createDataFrame([(1, "ABC | ABC"), (2, "DEF &amp; пасьля"), (3, ""), (4, None)], "id int, text string")
    specs = [{"name": "languagetool", "client": Bars, "word_freq_top": 1}, {"name": "ftfy"}, {"name": "wikificator"}]
    done, s = pipeline.run(df, pipeline.build(specs))
    assert {r.id: r.text for r in done.collect()} == {1: "ABC | ABC", 2: "DEF & пасля", 3: "", 4: None} and set(done.columns) == {"id", "text", "metrics"}
    one = s["languagetool"]
    assert one["issue_type_totals"] == {"misspelling": 3, "typographical": 1} and one["rows_with_matches"] == 2 and one["excluded_proper_nouns_total"] == 0
    assert (one["distinct_flagged_words"], one["total_flagged_word_occurrences"], one["top_flagged_words"], one["top_rule_ids"]) == (2, 3, {"abc": 2}, {"LOUD": 3})
    assert one["match_count_quantiles"] == {"p10": 0, "p50": 1, "p90": 3, "p99": 3}
    assert s["ftfy"]["explanation_kinds"] == {"apply": 1} and sum(s["wikificator"]["rule_fire_counts"].values()) == 1
    assert "top_rule_ids" not in pipeline.run(df, pipeline.build([{"name": "languagetool", "client": Bars, "track_word_freq": False}]))[1]["languagetool"]


def test_mean_quality(spark):
    stage = lambda: pipeline.build([{"name": "blaser", "encode": lambda t: [[len(x)] for x in t], "score": lambda a, b: [x[0] + y[0] for x, y in zip(a, b)]}], pipeline.NEURAL)
    df = spark.createDataFrame([("a", "b"), ("", "abc"), (None, "")], "src string, tgt string")
    one = pipeline.run(df, stage())[1]["blaser"]
    assert one["rows_total"] == 3 and one["mean"] == pytest.approx(5 / 3) and one["score_quantiles"]["p50"] == 2.0
    assert "mean" not in pipeline.run(df.limit(0), stage())[1]["blaser"]


def test_commands(spark, tmp_path):
    text = "a sentence that is long enough to be compared with another one"
    source = tmp_path / "in.jsonl"
    source.write_text("".join(json.dumps(x) + "\n" for x in [{"text": text + " [3]", "n": 1}, {"text": text, "n": 2}, {"text": "something else that nobody has ever written before", "n": 3}]) + "\n")

    def config(name, body):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps({"stats_dir": str(tmp_path / "stats"), "stats_prefix": "t"} | body))
        return ["--config", str(path)]

    at = lambda name: str(tmp_path / name)
    assert cli.main(["pipeline", *config("p", {"input": str(source), "output": at("clean"), "stages": [{"name": "citations"}]})]) == 0
    assert cli.main(["dedup", *config("d", {"input": at("clean"), "output": at("marked"), "text_field": "text", "minhash": {"num_proc": 1}})]) == 0
    assert cli.main(["filter", *config("f", {"input": at("marked"), "survived": at("kept"), "rejected": at("lost"), "filters": [{"name": "first", "type": "require_true", "key": "metrics.dedup_keeper"}]})]) == 0
    assert cli.main(["export", *config("e", {"input": at("kept"), "output": at("out"), "format": "jsonl", "columns": ["n", "metrics.dedup_keeper"]})]) == 0
    assert lines(tmp_path / "out") == [{"n": 1, "metrics.dedup_keeper": True}, {"n": 3, "metrics.dedup_keeper": True}]
    assert [x["filtered_by"] for x in lines(tmp_path / "lost")] == [["first"]]
    stats = {p.name: json.loads(p.read_text()) for p in (tmp_path / "stats").iterdir()}
    assert set(stats) == {"t_citations.json", "t_dedup.json", "t_filter.json", "t_export.json"} and stats["t_dedup.json"]["rows_dropped"] == 1


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"text": "x [1]"}\n{"text": "y"}\n')
    stream = spark.readStream.schema("text string").json(str(tmp_path / "in"))
    kept, _ = streaming.filter_stream(streaming.clean_stream(stream, pipeline.build([{"name": "citations"}])), [{"name": "no_y", "type": "not_contains", "key": "text", "substring": "y"}])
    seen = []
    streaming.each_batch(kept, lambda df, _: seen.extend(r.text for r in df.collect()), str(tmp_path / "cp")).awaitTermination(60)
    assert seen == ["x"]


def test_entry_point_without_the_llm_parts():
    import __spark_entry__ as entry
    from corpusloom.plans import catalogue

    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
