"""From documents to packed training sequences: five stages, each over all that the one before it kept.

Defined cases, beyond those of the operators: every row is judged by its own text and source, also where its doc_id
is null or repeated. A null or empty text is scored like any other and fails the quality rules. Near-duplicate removal
keeps the row with the smallest doc_id of a group, with its repetitions, and all rows without a doc_id. Very long texts pass
whole. Other columns pass through all stages but the last, whatever their names; the last has columns of its own.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import line_quality, near_copies, packing, pii, quality_crf
from ledgerline.llm.common import checkpointed, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of `sf_dir`, predicts good."""
    return quality_crf.accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and are not depleted by their host's frequent lines."""
    return line_quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by five-word shingles, the one with the smallest doc_id."""
    return near_copies.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document: the sequence it goes to and its place there."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: A random field, fingerprint components and packing are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = checkpointed(docs)
    return docs
