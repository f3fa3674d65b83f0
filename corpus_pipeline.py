"""A corpus from raw documents: quality, near-dedup, decontamination, mixing, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, the last
one with ``shard`` and ``slot`` added. Between stages the documents are written as
Parquet and read again, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeloom.llm import decontaminate, mixing, quality_rules, sharding, simhash
from edgeloom.llm.tables import table, written

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints at most 2 bits apart) the document of smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target shares of source, language and topic."""
    return mixing.sample_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard and its place there."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: Fingerprints, MinHash and seeded draws have no DuckDB form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
