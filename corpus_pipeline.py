"""The corpus pipeline: quality, toxicity, near-duplicates, repeated passages and packing, one stage after the other.

A stage takes the documents that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelines.llm import quality, simhash, substring, toxicity
from tidelines.llm.common import documents, labels, staged
from tidelines.llm.queries import packed


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the quality threshold go."""
    return quality.keep_good(docs, quality.train(documents(spark, sf_dir), labels(spark, sf_dir)))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of toxicity over the threshold go."""
    return toxicity.keep_civil(docs, toxicity.train(documents(spark, sf_dir), labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go. Only texts that lose words change."""
    return substring.without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packing),
]

#: No SQL: the stages learn models, compare fingerprints and pack greedily. tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; between stages documents are written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
