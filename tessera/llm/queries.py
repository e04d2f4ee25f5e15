"""The registered corpus queries: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    decontaminate,
    filter_audit,
    langid,
    minhash,
    ordinal_quality,
    prefix_trie,
    quality_rules,
    secrets_forest,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
    warc,
    word_bpe,
)
from tessera.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.report(decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sentencepiece_codec.digests(sentencepiece_codec.encode_documents(docs, model))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_forest.scan_documents(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels")
    grade = ordinal_quality.toxic_aware_grade(labels["quality"], labels["toxic"])
    model = ordinal_quality.fit_grades(docs, labels.select("doc_id", grade.alias("grade")))
    return ordinal_quality.grade_documents(docs, model)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = word_bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return word_bpe.digests(word_bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), content))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_rules, op2_warc, op3_decontamination, op4_sentencepiece, op5_suffix_dedup, op6_sharding,
        op7_language_id, op8_secret_scan, op9_minhash_near_dedup, op10_quality_classifier,
        op11_filter_audit, op12_prefix_trie, op13_word_bpe,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Queries whose result SQL can state; the others are tested against brute force in tests/llm."""
    return {"op1_quality_rules": quality_rules.oracle_sql(), "op2_warc": warc.oracle_sql(), "op11_filter_audit": filter_audit.oracle_sql()}
