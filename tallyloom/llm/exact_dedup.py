"""Exact deduplication by skew-safe combining.

Three stages of aggregation, each grouped by digest and full content, so equal digests of different
texts never merge: every task combines its own rows (Spark's partial aggregation), digest groups are
merged per salt, and the winners of the salts are combined per digest. The salt is the number of the
task that read the row, so a text with many copies leaves a task as one row and reaches a merging
task from at most a ``salts``-th of the tasks; the last stage gets at most ``salts`` rows per text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import ascii_lower, free_names, read, stored, text_or_empty

SALTS = 16


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per input row: its group, the group's size and whether the row stays.

    Texts are equal when they are identical after lower-casing A-Z; a missing text is an empty one.
    The largest ``doc_id`` of a group stays (a missing id is smaller than any). Rows that repeat both
    id and text are told apart by nothing, so all of them are marked as kept. Other columns are ignored.
    Two different texts with one SHA-256 would end the job with an error rather than be merged.
    """
    rows = docs.select(F.col("doc_id"), ascii_lower(text_or_empty()).alias("text")).withColumn("sha", F.sha2("text", 256))
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = salted.groupBy("sha", "salt", "text").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    combined = merged.groupBy("sha", "text").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    classes = combined.groupBy("sha").agg(F.max("top").alias("keep_id"), F.max("n").alias("group_size"), F.count("*").alias("contents"))
    # Written first: a text with many copies then meets its class in a join whose skew Spark can split.
    classes = stored(classes, "exact-classes")
    one = F.when(F.col("contents") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("one digest, two texts")).cast("bigint"))
    return rows.select("doc_id", "sha").join(classes, "sha").select(
        "doc_id",
        "keep_id",
        one.alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows of one id and text any one stays."""
    of, by_id, by_sha, times = free_names(docs, "__of", "__id", "__sha", "__times")
    kept = exact_groups(docs, salts).filter("kept").groupBy(F.col("doc_id").alias(by_id), F.col("text_sha256").alias(by_sha)).agg(F.count("*").alias(times))
    rows = docs.withColumn(of, F.sha2(ascii_lower(text_or_empty()), 256))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(by_id)) & (F.col(of) == F.col(by_sha)))
    once = rows.filter(F.col(times) == 1)
    repeated = rows.filter(F.col(times) > 1).dropDuplicates([by_id, by_sha])
    return once.unionByName(repeated).select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups over all documents."""
    return exact_groups(read(spark, sf_dir, "documents"))


OP6_SQL = """
with n as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id is not distinct from max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""
