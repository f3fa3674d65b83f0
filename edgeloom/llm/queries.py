"""The registered queries of the subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edgeloom.llm import (
    chat_format,
    decontaminate,
    license_scan,
    mixing,
    prefix_trie,
    quality_rules,
    repeats,
    sharding,
    simhash,
    spelling_variants,
    substring_dedup,
    suffix_tree_lm,
    token_files,
)
from edgeloom.llm.oracle import ORACLE
from edgeloom.llm.tables import table

__all__ = ["ORACLE", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_report(spark, table(spark, sf_dir, "conversations"))


def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score_report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variant_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_license_scan": op2_license_scan,
    "op3_sharding": op3_sharding,
    "op4_repeats": op4_repeats,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat_format": op8_chat_format,
    "op9_suffix_tree_lm": op9_suffix_tree_lm,
    "op10_decontamination": op10_decontamination,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
