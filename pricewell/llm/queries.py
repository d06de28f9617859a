"""The registered query of each operator, and DuckDB SQL where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_collapse, conversation_repair, crossparse_lang, embedding_dedup, importance_resample, mix_threshold,
               pii_crf, simhash_anchor, sparse_suffix, superkmer_dedup, tiling, token_repair, vector_packing)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_token_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_repair.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op3_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.format_chats(table(spark, sf_dir, "conversations"))


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op5_simhash_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_anchor.near_dedup(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")


def op6_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"), window=50)


def op7_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer_dedup.dedup_substrings(table(spark, sf_dir, "documents"), window=50)


def op8_mix_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_threshold.mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), epochs=3)


def op9_crossparse_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossparse_lang.identify(table(spark, sf_dir, "documents"))


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op13_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.digest(pii_crf.personal_data(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_embedding_dedup, op2_token_repair, op3_chat_collapse, op4_vector_packing, op5_simhash_anchor,
        op6_sparse_suffix, op7_superkmer_dedup, op8_mix_threshold, op9_crossparse_lang, op10_string_tiling, op11_importance_resample,
        op12_conversation_repair, op13_pii_crf)
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_collapse": chat_collapse.ORACLE,
    "op8_mix_threshold": mix_threshold.ORACLE,
}
