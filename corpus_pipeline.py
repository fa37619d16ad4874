"""Raw documents to a sharded training mix, one operator per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from almanac.llm import decontaminate, language, mixing, sharding, simhash
from almanac.llm.queries import SHARDS, with_library
from almanac.plans.inputs import table
from almanac.staging import stage


# Bits per byte from which a text is in none of the learned languages; 8 is what bytes take without a model.
UNREADABLE = 7.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in a learned language; those without a letter or that no language shortens go."""
    return language.readable(docs, language.train_folds(docs), UNREADABLE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, shard and slot."""
    return sharding.assign(docs, shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("identify_language", identify_language),
    ("drop_near_copies", drop_near_copies),
    ("drop_benchmark_leaks", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

ORACLE_SQL: str | None = None


@with_library
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, step in before:
        docs = stage(step(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
