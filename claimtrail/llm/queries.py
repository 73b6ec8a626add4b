"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimtrail.llm import chat_format, decontaminate, line_dedup, merkle, minhash_join, pii_feistel, quality_gbt, quality_knn, sentencepiece_bpe, sharding, simhash_dedup, substring_dedup, turn_repair

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """Path of one of the installed public tokenizers' files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@query("op10_benchmark_decontamination", decontaminate.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_line_dedup", line_dedup.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op8_simhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.digest(table(spark, sf_dir, "documents"))


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digest(table(spark, sf_dir, "documents"), tokenizer())


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_chat_format", chat_format.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(chat_format.format_records(chat_format.with_tricky(table(spark, sf_dir, "conversations"))))


@query("op5_sharding", sharding.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.QUERY_BYTES)


@query("op9_pii_pseudonyms")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.digest(table(spark, sf_dir, "documents"))


@query("op3_substring_dedup", substring_dedup.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


@query("op11_turn_repair", turn_repair.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digest(table(spark, sf_dir, "conversations"))


@query("op12_minhash_dedup", minhash_join.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.digest(table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", merkle.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))
