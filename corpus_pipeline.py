"""The corpus pipeline: five operators of ``pricewell.llm`` one after the other over ``documents``.

Each stage takes what the stage before kept, written as Parquet and read again, so that a lost
executor costs at most the stage that runs. All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewell.llm import crossparse_lang, mix_threshold, simhash_anchor, tiling, vector_packing
from pricewell.llm.shared import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; those whose text is in no language (``und``) go."""
    found = crossparse_lang.predict(docs, crossparse_lang.learn(docs))
    return found.filter(found.lang_pred != crossparse_lang.UNKNOWN).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return simhash_anchor.kept_documents(docs, shingle=3, bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken up to its target; a document taken twice is two rows."""
    return mix_threshold.mixed_documents(docs, weights=(5.0, 2.0, 1.0), epochs=3)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its place in it."""
    return vector_packing.shard_documents(docs, shards=24, columns=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

# SQL can't express the learned language model, SimHash or the packing; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
