"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before left, written as Parquet and read again, and decides over all of
it. All but the last keep the columns of ``documents``; the last gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, exact_dedup, packing, quality, simhash
from tallyloom.llm.common import read, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from ``labels``, does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.exact_dedup(docs)


def distinct_near_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash.near_dedup(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document left, with the sequence and offset they go to."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_near_texts),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed),
]

# Tokenization, fingerprints and a trained model are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
