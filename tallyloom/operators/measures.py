"""The parametric measures behind every Gold query.

Each one is a partial aggregation before its only wide shuffle, so what moves between
executors is one row per task and group, however many rows a single answer holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import flag_sum, mean_of, percent, quoted

COUNT, SHARE, MEAN = "total", "percentual", "salario_medio"


def known(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which every one of these answers is present."""
    return df.where(" and ".join(f"{quoted(column)} is not null" for column in columns))


def ordered(df: DataFrame, *order: str, top: int | None = None) -> DataFrame:
    """Sorted, with missing values last. A leading ``-`` sorts that column downwards."""
    keys = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in order]
    result = df.orderBy(*keys)
    return result if top is None else result.limit(top)


RANK = "posicao"


def numbered(result: DataFrame, *order: str) -> DataFrame:
    """A finished result with each row's position in its order, as a column and as the order of the rows.

    For results, whose rows are as many as their categories: one task numbers them.
    """
    keys = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in order]
    return result.withColumn(RANK, F.row_number().over(Window.orderBy(*keys))).orderBy(RANK)


def with_share(
    counts: DataFrame, within: str | None = None, half_even: bool = False, groups: Sequence[str] | None = None
) -> DataFrame:
    """Share of each counted row in the whole, or in its ``within`` group.

    The whole is a second, tiny aggregation over the counts: Spark reuses their shuffle for
    it, and no window has to gather all counted rows, or all rows of one group, in one task.

    ``groups`` lists all values that ``within`` may have, for groups that are few and known, such as
    editions. Their wholes, as many rows as the list has, are broadcast, so the counts of a group need
    not meet in one task. A group that is not listed is an error. Without a list Spark picks the join.
    """
    if within is None:
        # Naming every column keeps the subquery's aggregation identical to the counts', so that
        # Spark reuses it instead of scanning the respondents again for a leaner one.
        named = (F.count(column) for column in counts.columns)
        whole = counts.agg(F.struct(F.sum(COUNT).alias("respondents"), *named)).scalar()["respondents"]
        return counts.withColumn(SHARE, percent(F.col(COUNT), whole, half_even=half_even))
    wholes = counts.groupBy(F.col(within).alias("_within")).agg(F.sum(COUNT).alias("_whole"))
    if groups is not None:
        # Checked on the wholes as they are: a filter would reach the scan and make it another one.
        unlisted = F.raise_error(F.concat(F.lit(f"{within} is not listed: "), F.coalesce(F.col("_within").cast("string"), F.lit("NULL"))))
        checked = F.when(F.col("_within").isin(*groups), F.col("_whole")).otherwise(unlisted.cast("bigint"))
        wholes = F.broadcast(wholes.withColumn("_whole", checked))
    joined = counts.join(wholes, F.col(within).eqNullSafe(F.col("_within")))
    return joined.withColumn(SHARE, percent(F.col(COUNT), F.col("_whole"), half_even=half_even)).drop("_within", "_whole")


def share(df: DataFrame, answer: str, within: str | None = None, groups: Sequence[str] | None = None) -> DataFrame:
    """Respondents per answer and their share; a missing answer is not counted."""
    keys = [answer] if within is None else [within, answer]
    counts = known(df, [answer]).groupBy(*keys).agg(F.count("*").alias(COUNT))
    return with_share(counts, within, groups=groups)


def mean_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    min_count: int | None = None,
    only: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Mean of ``value`` and group size per key combination.

    Rows lacking a key or the value do not count. ``only`` restricts answers to listed
    ones, ``min_count`` drops groups too small to report.
    """
    for column, answers in (only or {}).items():
        df = df.where(F.col(column).isin(*answers))
    required = [key for key in keys if key not in (only or {})] + [value]
    means = known(df, required).groupBy(*keys).agg(mean_of(F.col(value)).alias(MEAN), F.count("*").alias(COUNT))
    return means if min_count is None else means.where(F.col(COUNT) >= min_count)


def flag_profile(
    df: DataFrame, flags: Iterable[str], value: str, name: str, min_count: int | None = None
) -> DataFrame:
    """Mean of ``value`` by number of flags set; respondents lacking a flag are their own group."""
    counted = known(df, [value]).select(flag_sum(flags).alias(name), value)
    means = counted.groupBy(name).agg(mean_of(F.col(value)).alias(MEAN), F.count("*").alias(COUNT))
    return means if min_count is None else means.where(F.col(COUNT) >= min_count)


def flag_adoption(df: DataFrame, flags: Mapping[str, str], name: str, total: str) -> DataFrame:
    """Respondents per flag set: one scan and one row of sums, turned into one row per flag."""
    sums = df.agg(*(F.expr(f"sum(cast({quoted(flag)} as int))").alias(label) for label, flag in flags.items()))
    return sums.unpivot([], [quoted(label) for label in flags], name, total)


def share_and_mean(df: DataFrame, answer: str, value: str) -> DataFrame:
    """Share of each answer and mean of ``value``; respondents without a value still count."""
    counts = (
        known(df, [answer]).groupBy(answer).agg(F.count("*").alias(COUNT), mean_of(F.col(value)).alias(MEAN))
    )
    return with_share(counts).select(answer, COUNT, SHARE, MEAN)
