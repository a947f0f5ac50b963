"""Corpus pipeline: quality rules, near duplicates, decontamination, mixing and sharding, each stage on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm import jaccard, leaks, mixing, quality, shards
from granary.llm.common import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked shares of source, language and topic."""
    return mixing.sample(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return shards.shard(docs, shards=8, whole=True)


STAGES = [(f.__name__, f) for f in (quality_rules, near_duplicates, decontamination, mix_sources, sharding)]

#: Sampling by a 64-bit hash and the exact k-d cuts have no SQL form; the stages are tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        done = scratch.put(stage(spark, docs, sf_dir))
        if hasattr(docs, "scratch_path"):
            scratch.drop(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
