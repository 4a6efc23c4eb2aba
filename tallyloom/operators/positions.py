"""Positions and running totals over any number of rows: no task ever holds the whole order.

Rows are dealt to range partitions of the order and numbered inside each; the counts of the partitions, a
row for each, tell where every partition begins. Running totals work alike over stretches of positions.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import quoted
from tallyloom.operators.measures import RANK
from tallyloom.session import shared_dir

# Rows whose running total one task adds up.
STRETCH = 1_000_000
# Spark numbers the rows of a partition in the lower 33 bits.
ROW_BITS = 33


def order_keys(order: tuple[str, ...]) -> list[Column]:
    """Sort keys with missing values last. A leading ``-`` sorts that column downwards."""
    return [F.desc_nulls_last(quoted(c[1:])) if c.startswith("-") else F.asc_nulls_last(quoted(c)) for c in order]


def positioned(df: DataFrame, *order: str, parts: int | None = None) -> DataFrame:
    """Every row with its position, from 1, in the order of the named columns.

    The order should end with a key: rows that tie in all of it get consecutive positions in no fixed
    order. Rows are shuffled once and written to the shared folder as they were dealt, so that positions
    stay what they are when an executor is lost. ``parts`` is the number of range partitions (that of
    Spark's shuffles without it); one row for each goes through the driver.

    A key that ties in more rows than a task can hold should be followed by others: equal keys stay together.
    """
    spark = df.sparkSession
    part, row = _free(df, "_part"), _free(df, "_row")
    keys = order_keys(order)
    dealt = df.repartitionByRange(*([] if parts is None else [parts]), *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    dealt = dealt.withColumn(row, number.bitwiseAND(F.lit((1 << ROW_BITS) - 1))).withColumn(part, F.spark_partition_id())
    folder = f"{shared_dir(spark)}/positions/{uuid.uuid4().hex}"
    dealt.write.parquet(folder)
    rows = spark.read.schema(dealt.schema).parquet(folder)
    sizes = sorted(tuple(r) for r in rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
    starts = _starts(rows, part, sizes, "bigint")
    position = (F.col(part + "_start") + F.col(row) + 1).alias(RANK)
    return rows.join(F.broadcast(starts), part).select(*(F.col(quoted(c)) for c in df.columns), position)


def running_total(ranked: DataFrame, value: str, name: str, stretch: int = STRETCH) -> DataFrame:
    """``value`` added up in the order of positions, each row's own included; a missing value adds nothing.

    Whole numbers are added as such, others as decimals of six places, so that totals do not depend on how rows
    are dealt. Positions are shuffled once by equal stretches, whose
    sums are a row each.
    """
    whole = isinstance(ranked.schema[value].dataType, T.IntegralType)
    exact = F.col(quoted(value)).cast("bigint" if whole else "decimal(28,6)")
    block = _free(ranked, "_stretch")
    rows = ranked.withColumn(block, F.floor((F.col(RANK) - 1) / F.lit(stretch)).cast("bigint"))
    sums = rows.groupBy(block).agg(F.coalesce(F.sum(exact), F.lit(0)).cast("decimal(38,6)").alias("n"))
    starts = _starts(rows, block, sorted(tuple(r) for r in sums.collect()), "decimal(38,6)")
    up_to = Window.partitionBy(block).orderBy(RANK).rowsBetween(Window.unboundedPreceding, 0)
    within = F.coalesce(F.sum(exact).over(up_to), F.lit(0)).cast("decimal(38,6)")
    before = _free(ranked, "_within")
    summed = rows.withColumn(before, within).join(F.broadcast(starts), block)
    total = (F.col(block + "_start") + F.col(before)).cast("bigint" if whole else "decimal(38,6)")
    return summed.select(*(F.col(quoted(c)) for c in ranked.columns), total.alias(name))


def _starts(rows: DataFrame, part: str, sizes: list[tuple], kind: str) -> DataFrame:
    """What lies before each part: as many rows as there are parts."""
    ends = accumulate(size for _, size in sizes)
    starts = [(number, end - size) for (number, size), end in zip(sizes, ends, strict=True)]
    return rows.sparkSession.createDataFrame(starts, f"{part} bigint, {part}_start {kind}")


def _free(df: DataFrame, name: str) -> str:
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken or f"{name}_start".lower() in taken:
        name += "_"
    return name
