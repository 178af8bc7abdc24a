"""Cleaning a corpus: each stage takes (spark, docs, sf_dir), is written as Parquet, and is the next stage's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import bpe, decontaminate, minhash, pii, quality
from ebbtide.llm.common import staged, table


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the classifier rejects go, all others stay with all their columns.

    Null and empty texts are scored like others, repeated rows alike. Without labels of both classes, or without rows,
    there is nothing to learn from: the classifier's prior decides for all rows the same.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near duplicates stays (five-word shingles, similarity 0.8).

    The smallest doc_id of a group stays; rows equal in doc_id and text stay once, rows of one doc_id with unlike texts
    all stay, and so do texts without words. A group of rows without a doc_id keeps one row.
    """
    return minhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a copy of a test item go.

    Decided row by row, by the text alone: null and empty texts stay, repeated rows and rows without a doc_id are judged
    alike. An empty benchmark drops nothing.
    """
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: personal data is replaced; the classifier is trained on the stage's own input.

    No row is dropped. Null texts stay null, n_chars is counted anew. Without rows nothing is trained or replaced.
    """
    return pii.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids in place of each text, beside the other columns, and digests of ids and of what they decode to.

    ``ids`` holds little-endian unsigned 32-bit integers, from which ``bpe.decode`` makes the text again. Null and empty
    texts have no ids; every row gives a row.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = bpe.Vocabulary.load(path, public_tokenizers.PATTERN)
    kept = [name for name in docs.columns if name != "text"]
    # the workers of the stages before keep their caches, so a task of this one remembers a block's words only
    encoded = bpe.encode(docs, vocabulary, with_decoded=True, keep=kept, task_words=60_000)
    return bpe.with_digests(encoded)


STAGES = [
    ("keep_good_documents", keep_good_documents),
    ("keep_one_of_near_duplicates", keep_one_of_near_duplicates),
    ("drop_benchmark_leaks", drop_benchmark_leaks),
    ("redact_personal_data", redact_personal_data),
    ("encode_tokens", encode_tokens),
]
#: No SQL: the stages hold a trained model, sketches and alignments. They are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, whole."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
