"""A training-corpus pipeline over ``documents``: quality rules, exact dedup,
near-dedup, mixing to target weights, sampled tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; ``run`` stores each stage's result below ``spark.checkpoint.dir``
before the next one reads it. So each stage's documents are a table on files, and
stages name a row by its place there instead of storing a numbered copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderstream.llm import exact_dedup, mixing, near_dedup, quality, sampled_pieces
from orderstream.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs, on_files=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, 80 % similar."""
    return near_dedup.keep_one(docs, on_files=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, on_files=True)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sampled_pieces.encode(docs, sampled_pieces.load())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("segmentations", segmentations),
]
#: Learned cutoffs, minhash and sampled segmentations have no SQL form; the
#: stages are tested against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
