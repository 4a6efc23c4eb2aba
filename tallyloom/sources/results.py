"""Query results as CSV: a header, every field quoted, missing values empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.sources.survey_csv import DIALECT


def write_result(df: DataFrame, folder: str) -> None:
    """Export a result in its order.

    Nothing is squeezed into one task: adaptive execution already merges a small sorted
    result into one file, and a large one becomes several part files whose names sort in row order.
    """
    df.write.mode("overwrite").options(**DIALECT).option("quoteAll", True).csv(folder)


def read_result(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """Read an export back with its known schema; empty fields are NULL."""
    return spark.read.schema(schema).options(**DIALECT).options(multiLine=True, lineSep="\n").csv(folder)
