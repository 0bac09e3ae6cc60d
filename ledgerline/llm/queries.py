"""The operators' queries over whole tables, with their production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, conversations, license_index, line_quality, ogg, packing, pii, quality_crf, ranked_search, simhash, substrings, token_counts, url_templates
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judged(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.filtered(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, clusters=simhash.near_duplicates(docs))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.media_digests(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.searched(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_counts, op2_quality_rules, op3_simhash, op4_url_filters, op5_pii, op6_quality_classifier, op7_best_fit_packing, op8_media_columns, op9_byte_bpe, op10_license_scans, op11_conversation_repair, op12_substring_dedup, op13_ranked_search)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
