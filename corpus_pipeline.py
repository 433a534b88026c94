"""The corpus pipeline: stages that each read their predecessor's rows and return documents.

Language ID drops what has no recognisable language, near-dedup keeps one document of each group, decontamination drops
documents that hold benchmark passages, the mix repeats or leaves out documents so that sources meet their weights,
and sharding adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetwarden.llm import decontaminate, language, mixing, near_dups, sharding
from fleetwarden.llm.frames import table
from fleetwarden.session import staged

# SQL expresses neither the trained model nor the random draws; tests compare the stages with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts that are null, empty or without letters go, extra columns stay."""
    return language.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, ids or not; null, empty and wordless texts stay, but for rows of one id and text."""
    return near_dups.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts stay, an empty benchmark drops nothing."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; repeated rows are drawn one by one, a null source is a source."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot, columns of these names replaced; null ids and texts have places like any row."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through all stages; each result is written to the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs
