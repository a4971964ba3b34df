"""A training-data pipeline over documents, built of the operators in saldo.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saldo.llm import common, exact_dedup, language, packing, simhash, suffix_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which a language is found."""
    return language.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of equal texts."""
    return exact_dedup.kept(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies."""
    return simhash.kept(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that another document, or the same one, has before."""
    return suffix_dedup.shortened(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of what is left into sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", find_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

#: No SQL: language profiles, fingerprints and packing have no counterpart in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each one's result is written and read again.

    What is written stays until ``common.clear_scratch``, as the result reads it.
    """
    docs = common.documents(spark, sf_dir)
    folder = common.scratch_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
