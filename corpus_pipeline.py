"""The corpus pipeline: stages that each take documents and return the documents they keep, the last their token ids.

Every stage works on all that the stage before it kept. ``run`` writes each stage's rows to the shared folder and reads them again for
the next, so a lost executor costs one stage at most. Text changed by a stage comes with ``n_chars`` counted anew.

Defined cases: each stage treats nulls, empty and very long texts, repeated rows, empty tables and further columns as its operator
states. The near-duplicate stage leaves one row of each doc_id and text. The last stage gives a null or empty text no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimtrail.llm import decontaminate, line_dedup, quality_knn, sentencepiece_bpe, simhash_dedup
from claimtrail.llm.queries import table, tokenizer
from claimtrail.sources.scratch import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours vote for good quality. The labelled documents are looked up among ``docs``."""
    return quality_knn.accepted(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document holds too if three documents or more do."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked by three bits or fewer."""
    return simhash_dedup.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number of tokens, and digests of the ids and of the text they decode to."""
    return sentencepiece_bpe.digest(docs, tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("simhash_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Nearest-neighbour voting, fingerprint links and piece encoding are not expressible in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
