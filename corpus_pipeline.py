"""A corpus pipeline of five stages, each one operator of ``listenhouse.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listenhouse.llm import decontaminate, language, mixing, near_dedup, sharding
from listenhouse.llm.staging import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language.drop_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens stay, mixed by domain, language and source."""
    return mixing.keep_mixed(docs, (9, 10))


def kd_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard, one of eight, and its slot there."""
    return sharding.with_shards(docs, n_shards=8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("sharding", kd_sharding),
]

#: SQL cannot express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
