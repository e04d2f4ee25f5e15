"""Corpus pipeline: quality rules, near-dedup, decontamination, secret scan, token encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, minhash, quality_rules, secrets_forest, sentencepiece_codec
from tessera.llm.common import shared_folder, table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go (operator 1)."""
    return quality_rules.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (operator 9)."""
    return minhash.drop_near_duplicates(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go (operator 3)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays (operator 8)."""
    return secrets_forest.mask_secrets(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to (operator 4)."""
    model = sentencepiece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepiece_codec.digests(sentencepiece_codec.encode_documents(docs, model))


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode_tokens),
]

#: SQL cannot express the near-dedup, secret and token stages; the run is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
