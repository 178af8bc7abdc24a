"""One query per operator, each over its whole table with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import (
    bpe,
    decontaminate,
    filter_audit,
    fingerprints,
    licenses,
    minhash,
    neighbours,
    pii,
    quality,
    secrets,
    sql,
    token_files,
    warc,
    word_runs,
)
from ebbtide.llm.common import table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"), path)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.where("vec_id % 20 = 0"), vectors, k=20)


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = word_runs.with_planted_repeats(table(spark, sf_dir, "documents"))
    return word_runs.run_digests(word_runs.collapse_runs(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licenses": op1_licenses,
        "op2_quality": op2_quality,
        "op3_personal_data": op3_personal_data,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_warc": op5_warc,
        "op6_secrets": op6_secrets,
        "op7_token_files": op7_token_files,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_decontaminate": op9_decontaminate,
        "op10_fingerprints": op10_fingerprints,
        "op11_filter_audit": op11_filter_audit,
        "op12_neighbours": op12_neighbours,
        "op13_word_runs": op13_word_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": sql.ARCHIVES,
        "op8_near_duplicates": sql.NEAR_DUPLICATES,
        "op11_filter_audit": sql.FILTER_AUDIT,
    }
