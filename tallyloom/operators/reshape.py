"""Operators that shape a Gold result for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import relative_gap


def weighted_mean(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, digits: int = 6
) -> DataFrame:
    """Mean of ``value`` weighted by ``weight``, and the summed weight, per key.

    Rounded, since the order of a floating-point sum differs from run to run.
    """
    mean = F.sum(F.col(value) * F.col(weight)) / F.sum(weight)
    return df.groupBy(*keys).agg(F.sum(weight).alias(weight), F.round(mean, digits).alias(value))


def plain_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, digits: int = 6) -> DataFrame:
    """Unweighted counterpart of :func:`weighted_mean`, for results without counts."""
    return df.groupBy(*keys).agg(F.sum(weight).alias(weight), F.round(F.avg(value), digits).alias(value))


def largest(df: DataFrame, by: str, tie: str, top: int | None = None) -> DataFrame:
    """The ``top`` largest rows, smallest first as a bar chart draws them."""
    kept = df if top is None else df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tie)).limit(top)
    return kept.orderBy(F.asc_nulls_first(by), F.desc_nulls_first(tie))


def rank_in(column: str, order: Sequence[str]) -> Column:
    """Position of a category in a custom order; NULL for one that is not listed."""
    position = F.array_position(F.array(*(F.lit(category) for category in order)), F.col(column))
    return F.nullif(position, F.lit(0))


def pivot_unique(df: DataFrame, index: str, column: str, value: str, order: Sequence[str]) -> DataFrame:
    """One row per ``index``, one column per listed category; two values for one cell are an error."""
    twice = F.raise_error(F.lit(f"more than one {value} for one {index} and {column}"))
    cell = F.when(F.count(F.lit(1)) > 1, twice.cast(df.schema[value].dataType)).otherwise(F.max(value))
    return df.groupBy(index).pivot(column, list(order)).agg(cell)


def pivot_sum(df: DataFrame, index: str, column: str, value: str, order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``index``, one column per category, cells summed and empty ones 0.

    Without ``order`` the categories come from the data, sorted; Spark refuses more of them
    than ``spark.sql.pivotMaxValues`` rather than dropping any. With it, a category that is not
    listed is an error.
    """
    if order is not None:
        unlisted = F.raise_error(F.concat(F.lit(f"{column} is not listed: "), F.coalesce(F.col(column), F.lit("NULL"))))
        df = df.withColumn(column, F.when(F.col(column).isin(*order), F.col(column)).otherwise(unlisted.cast("string")))
    pivoted = df.groupBy(index).pivot(column, None if order is None else list(order)).agg(F.sum(value))
    return pivoted.na.fill(0)


def matrix(df: DataFrame, index: str, column: str, value: str, cells: str = "celulas") -> DataFrame:
    """One row per ``index`` with a map from category to summed value, for categories that nobody has listed.

    Nothing has to look the categories up first, and there is no limit to their number but what one row
    holds. Cells are summed before they are gathered, so a row gathers each of its categories once.
    Missing values add nothing; a missing category is called ``null``, as a pivot calls it.
    """
    category = F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)
    summed = df.groupBy(F.col(index), category).agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
    entries = F.sort_array(F.collect_list(F.struct(column, value)))
    return summed.groupBy(index).agg(F.map_from_entries(entries).alias(cells))


def spread(rows: DataFrame, index: str, cells: str, order: Sequence[str]) -> DataFrame:
    """The columns of a :func:`matrix` drawn out in the given order; a category a row lacks is 0 there.

    A category that is not in ``order`` is an error, as in a listed pivot.
    """
    unlisted = F.array_except(F.map_keys(cells), F.array(*(F.lit(c) for c in order)).cast("array<string>"))
    failed = F.raise_error(F.concat(F.lit("not listed: "), F.array_join(unlisted, ", "))).cast(rows.schema[index].dataType)
    checked = F.when(F.size(unlisted) > 0, failed).otherwise(F.col(index)).alias(index)
    kind = rows.schema[cells].dataType.valueType
    return rows.select(checked, *(F.coalesce(F.col(cells)[F.lit(c)], F.lit(0).cast(kind)).alias(c) for c in order))


def group_gap(
    df: DataFrame, index: str, column: str, value: str, base: str, other: str, order: Sequence[str], digits: int = 1
) -> DataFrame:
    """Values of two groups side by side and how far ``other`` lies below ``base``, in custom order."""
    pivoted = pivot_unique(df.where(F.col(index).isin(*order)), index, column, value, [base, other])
    gap = F.round(relative_gap(F.col(base), F.col(other)), digits)
    return pivoted.select(index, base, other, gap.alias("gap_pct")).orderBy(rank_in(index, order))


def stack_offsets(df: DataFrame, index: str, column: str, value: str, order: Sequence[str]) -> DataFrame:
    """Where each segment of a stacked bar starts. A window holds one row per category.

    Categories that are not listed come last in the window and are left out after it: a filter before it
    would reach the counts on one side of their share only, which would then be scanned twice.
    """
    ranked = df.withColumn("_rank", rank_in(column, order))
    before = Window.partitionBy(index).orderBy(F.asc_nulls_last("_rank")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.round(F.coalesce(F.sum(value).over(before), F.lit(0.0)), 1)
    started = ranked.withColumn("acumulado", start).where("_rank is not null")
    return started.orderBy(index, "_rank").select(index, column, value, "acumulado")
