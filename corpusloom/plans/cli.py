"""Commands: pipeline, parallel, neural, dedup, filter, export, tatoeba-prep and moses-prep."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession

from corpusloom.core.workspace import cut
from corpusloom.operators import dedup, rules
from corpusloom.plans import pipeline
from corpusloom.plans.config import load_config
from corpusloom.sources import readers, writers


def run_stages(spark: SparkSession, cfg: dict, registry: dict) -> dict:
    for key in ("input", "output", "stats_dir", "stats_prefix", "stages"):
        cfg[key]
    done, statistics = pipeline.run(readers.read_jsonl(spark, cfg["input"]), pipeline.build(cfg["stages"], registry))
    writers.write_jsonl(done, cfg["output"])
    pipeline.write_statistics(statistics, cfg["stats_dir"], cfg["stats_prefix"])
    return statistics


def run_dedup(spark: SparkSession, cfg: dict) -> dict:
    """Rows are numbered by their place in the file."""
    from pyspark.sql import functions as F

    began = time.perf_counter()
    schema = readers.read_jsonl(spark, cfg["input"]).schema
    lines = readers.numbered_lines(spark, cfg["input"]).where(F.length(F.trim("value")) > 0)
    rows = lines.select(F.col("n").alias("_row"), F.from_json("value", schema).alias("r")).select("_row", "r.*")
    options = {k: v for k, v in cfg.get("minhash", {}).items() if k != "num_proc"}
    marked = dedup.mark_duplicates(rows, "_row", cfg["text_field"], **options)
    writers.write_jsonl(marked.drop("_row"), cfg["output"])
    out = {**dedup.statistics(marked), "text_field": cfg["text_field"], "minhash": options, "processing_time_s": round(time.perf_counter() - began, 3)}
    pipeline.write_statistics({"dedup": out}, cfg["stats_dir"], cfg["stats_prefix"])
    return out


def run_filter(spark: SparkSession, cfg: dict) -> dict:
    judged = cut(rules.judge(readers.read_jsonl(spark, cfg["input"]), cfg["filters"]), "judged")
    kept, lost = rules.split(judged)
    writers.write_jsonl(kept, cfg["survived"])
    writers.write_jsonl(lost, cfg["rejected"])
    out = rules.statistics(judged, cfg["filters"])
    pipeline.write_statistics({"filter": out}, cfg["stats_dir"], cfg["stats_prefix"])
    return out


def run_export(spark: SparkSession, cfg: dict) -> dict:
    out = writers.export(readers.read_jsonl(spark, cfg["input"]), cfg["output"], cfg["columns"], cfg.get("format", "parquet"), cfg.get("compression", "zstd"))
    pipeline.write_statistics({"export": out | {"input": cfg["input"]}}, cfg["stats_dir"], cfg["stats_prefix"])
    return out


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("pipeline", "parallel", "neural", "dedup", "filter", "export"):
        sub.add_parser(name).add_argument("--config", required=True)
    for name, sources in (("tatoeba-prep", ("input",)), ("moses-prep", ("src", "tgt"))):
        p = sub.add_parser(name)
        for s in (*sources, "output"):
            p.add_argument(f"--{s}", required=True)
        p.add_argument("--min-words", type=int, default=3)
        p.add_argument("--src-lang")
        p.add_argument("--tgt-lang")
    args = top.parse_args(argv)
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    if args.command in ("tatoeba-prep", "moses-prep"):
        options = {"min_words": args.min_words, "src_lang": args.src_lang, "tgt_lang": args.tgt_lang}
        rows = readers.read_pairs(spark, args.input, **options) if args.command == "tatoeba-prep" else readers.read_aligned(spark, args.src, args.tgt, **options)
        writers.write_jsonl(readers.written(rows), args.output)
        print(json.dumps(readers.counters(rows)), file=sys.stderr)
        return 0
    cfg = load_config(args.config)
    registries = {"pipeline": pipeline.MONO, "parallel": pipeline.PARALLEL, "neural": pipeline.NEURAL}
    if args.command in registries:
        out = run_stages(spark, cfg, registries[args.command])
    else:
        out = {"dedup": run_dedup, "filter": run_filter, "export": run_export}[args.command](spark, cfg)
    print(json.dumps(out, ensure_ascii=False, default=str), file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
