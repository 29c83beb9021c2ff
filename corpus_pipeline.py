"""The corpus pipeline: stages in order, each over all that the one before kept."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.core.workspace import cut_stage
from corpusloom.llm import jaccard_join, mixing, packing, quality, secrets

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go. Null and empty texts have no words and go; texts are read whole, however
    long; null ids, repeated rows and all columns stay as they are; of an empty table nothing is left."""
    return quality.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, one stays: that of the smallest id. Null
    and empty texts, and rows without id, link with nothing and stay; rows of one id with unlinked texts stay, repeated rows
    become one; texts are read whole; an empty table stays empty."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; every document stays. Null and empty texts, texts without a finding, null ids and
    repeated rows stay as they are; texts are read whole; an empty table stays empty."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are evened out half of the way, by repeating documents of the smaller ones: none is left out. The null
    source is one like others; null and empty texts come once; repeated rows share their uses evenly; an empty table stays empty."""
    return mixing.mix_sources(docs, budget_share=None, entropy_share=0.5, max_repeats=4.0, keep=True)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens. Null and empty texts are one token; longer
    documents are cut; rows without id and repeated rows are packed each for itself; an empty table gives no pieces."""
    return packing.pack_documents(docs, VOCABULARY, size=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenising with a vocabulary and a fit by least squares are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = None
    for name, stage in STAGES[:-1]:
        docs, path = cut_stage(spark, partial(stage, spark, docs, sf_dir), name, path)
    return STAGES[-1][1](spark, docs, sf_dir)
