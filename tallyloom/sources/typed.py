"""Types of text columns, found in one look at all their values.

The types form a lattice: whole numbers are also decimal numbers, and everything is also text. A column
gets the narrowest type that holds every value in it, as data-frame libraries decide on reading a CSV file:
whole numbers with a value missing are decimal numbers there, and so is a column without any value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import quoted
from tallyloom.sources.survey_csv import DIALECT

# Spellings of numbers and truth values. Blanks around them are allowed for numbers.
WHOLE = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
TRUTH = ("true", "True", "TRUE", "false", "False", "FALSE")


def _parsed(column: str, kind: str) -> Column:
    """The values of a text column as ``kind``, NULL where they are none."""
    value = F.col(quoted(column))
    if kind == "bigint":  # a number too long for 64 bits is none
        return F.when(value.rlike(WHOLE), F.trim(value).try_cast("bigint"))
    if kind == "double":
        return F.when(value.rlike(DECIMAL), F.trim(value).try_cast("double"))
    if kind == "boolean":
        return F.when(value.isin(*TRUTH), F.lower(value).try_cast("boolean"))
    return value


def found_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The type of each text column: one aggregation, one row to the driver, whatever the number of rows.

    Whole numbers that 64 bits cannot hold stay text where any value of the column is one, so no digit
    of a long identifier is lost.
    """
    columns = [name for name, kind in df.dtypes if kind == "string"] if columns is None else list(columns)
    counts = []
    for number, column in enumerate(columns):
        value = F.col(quoted(column))
        long_number = value.rlike(WHOLE) & F.trim(value).try_cast("bigint").isNull()
        counts += [
            F.count(value).alias(f"known_{number}"),
            F.count(_parsed(column, "bigint")).alias(f"whole_{number}"),
            F.count(F.when(long_number, 1)).alias(f"long_{number}"),
            F.count(_parsed(column, "double")).alias(f"number_{number}"),
            F.count(_parsed(column, "boolean")).alias(f"truth_{number}"),
        ]
    if not columns:
        return {}
    seen = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    return {column: _narrowest(seen, number) for number, column in enumerate(columns)}


def _narrowest(seen: Row, number: int) -> str:
    known, whole, too_long, numeric, truth = (seen[f"{what}_{number}"] for what in ("known", "whole", "long", "number", "truth"))
    if known == 0:
        return "double" if seen["rows"] else "string"  # without a row nothing is known
    if truth == known:
        return "boolean"
    if numeric < known or too_long:
        return "string"
    return "bigint" if whole == known == seen["rows"] else "double"


def typed(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Text columns under the types that :func:`found_types` gives them, all in one projection."""
    types = found_types(df) if types is None else types
    return df.select(*(_parsed(name, types[name]).alias(name) if name in types else F.col(quoted(name)) for name in df.columns))


def read_typed(spark: SparkSession, folder: str) -> DataFrame:
    """An exported result with the names of its header and the types its values have; empty fields are NULL.

    The values are looked at once before they are read. Where the schema is known, ``read_result`` needs no look.
    """
    return typed(spark.read.options(**DIALECT).options(multiLine=True, lineSep="\n").csv(folder))
