"""A corpus pipeline over ``documents``; each stage applies one operator to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctum.llm import fmindex, mixing, pii, quality, simhash
from punctum.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels outside the held-out fold.

    A null or empty text scores the mean label of the sample. Repeated rows have equal scores and stay or go together. Only ``text``
    decides, whatever is null elsewhere; an empty table gives an empty one.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"), held_out=0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that agrees in 0.8 of its five-word shingles.

    A text of fewer words is one shingle; null and empty texts are a group of their own. The smallest ``doc_id`` stays, null ids last,
    then the smallest hash of the text; of wholly equal rows one stays. An empty table gives an empty one.
    """
    return simhash.deduplicated(docs, words=5, similarity=0.8)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside benchmark passages of ten words.

    A document that is not hit stays as it is, null and empty texts too; one that loses all its words goes. Repeated rows are treated
    alike and all stay. Without documents or without a benchmark nothing changes.
    """
    return fmindex.decontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked.

    All rows stay, repeated ones too; null and empty texts are left as they are. An empty table gives an empty one.
    """
    return pii.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, a row for each copy, numbered by ``copy``.

    A null or empty text has size 0, and a null source is a source, the last. Ties are drawn by hashes, so reruns agree. An empty
    table gives an empty one.
    """
    return mixing.mix(docs, weights=(1, 2, 3), cap=3.0)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_masking", pii_masking),
    ("source_mixing", source_mixing),
]

#: A learned classifier and rounding by hash aren't SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
