"""A corpus pipeline: quality, near duplicates, personal data, mixing, packing. Each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkrekey.llm import mixing, near_dedup, packing, pii, quality_classifier
from sparkrekey.llm.common import read, work_folder, written
from sparkrekey.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the ordinal classifier, fitted on the labelled ones among them, doesn't reject."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard of at least 0.8)."""
    return near_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them: repeated for each pass, cut to the words taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences' pieces."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality_classifier", quality), ("near_dedup", near_duplicates), ("pii", personal_data), ("mixing", mix), ("packing", pack)]
#: No stage's model or draw can be put in SQL; tests compare each stage, on what the one before has kept, with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = work_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
