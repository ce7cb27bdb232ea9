"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Every stage reads what its predecessor wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import decontaminate, minhash, mixing, quality, sharding
from casebook.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the limits and the robust estimates reject go."""
    return quality.keep_good(docs)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest id stays."""
    return minhash.keep_one(docs, minhash.Rule(shingle=5, percent=80))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents to the target weights; documents of a source may repeat or be left out."""
    return mixing.mix_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document by the lookup table; adds slot and shard."""
    return sharding.place(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_dedup", keep_one),
    ("decontaminate", keep_clean),
    ("mix", mix),
    ("shard", shard),
]

#: The estimates and the bisection iterate, which SQL does not express; tests hold each stage against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
