"""Data-quality rules, all observed in one aggregation over the frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.catalog.answers import LANGUAGE_FLAGS, SALARY_MIDPOINTS
from tallyloom.functions import quoted, text


@dataclass(frozen=True)
class Rule:
    """A number observed on a frame and the range it must lie in.

    ``plain`` says that the number is a plain aggregate, which Spark can observe while a frame is written; ``known`` is a
    number that takes no look at the rows.
    """

    name: str
    observed: Column
    at_least: int | None = None
    at_most: int | None = None
    plain: bool = False
    known: int | None = None

    def passes(self, value: Column) -> Column:
        checks = [F.lit(True)]
        if self.at_least is not None:
            checks.append(value >= self.at_least)
        if self.at_most is not None:
            checks.append(value <= self.at_most)
        return reduce(Column.__and__, checks)


def has_columns(df: DataFrame) -> Rule:
    """The frame has at least one column. Metadata only."""
    return Rule("column_count", F.lit(len(df.columns)), at_least=1, known=len(df.columns))


def one_header(variants: int) -> Rule:
    """All files of an edition have one header. Files that differ are read each under its own."""
    return Rule("header_variants", F.lit(variants), at_most=1, known=variants)


def ids_unique(id_column: str) -> Rule:
    """No id occurs twice, as it would after loading an edition twice."""
    column = quoted(id_column)
    return Rule("duplicate_ids", F.expr(f"count({column}) - count(distinct {column})"), at_most=0)


def labels_known(column: str, known: Iterable[str], name: str = "unknown_labels") -> Rule:
    """Every non-empty answer is in the vocabulary; drifted wording shows up here."""
    vocabulary = ", ".join(map(text, ("", *known)))
    return Rule(name, F.expr(f"count_if({quoted(column)} not in ({vocabulary}))"), at_most=0, plain=True)


def flags_clean(columns: Iterable[str], name: str = "bad_flags") -> Rule:
    """Every non-empty flag is 0 or 1, so the strict integer cast cannot fail."""
    counts = (f"count_if({quoted(column)} not in ('', '0', '1'))" for column in columns)
    return Rule(name, F.expr(" + ".join(counts)), at_most=0, plain=True)


def edition_rules(df: DataFrame, columns: Mapping[str, str]) -> list[Rule]:
    """The rules for one edition whose unified -> present column names are given."""
    return [
        has_columns(df),
        ids_unique(columns["id_respondente"]),
        labels_known(columns["faixa_salarial"], SALARY_MIDPOINTS, "unknown_salary_bands"),
        flags_clean([columns[flag] for flag in LANGUAGE_FLAGS], "bad_language_flags"),
    ]


def quality_report(df: DataFrame, dataset: str, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: (dataset, rule, observed, passed). A single aggregation over ``df``."""
    rules = list(rules)
    numbers = df.agg(*(rule.observed.cast("bigint").alias(rule.name) for rule in rules))
    return _verdicts(numbers.withColumn("dataset", F.lit(dataset)), rules)


def observed(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, Observation | None]:
    """``df`` with the plain rules observed by the action that is run on it: no scan of their own."""
    plain = [rule for rule in rules if rule.plain]
    if not plain:
        return df, None
    watch = Observation()
    return df.observe(watch, *(rule.observed.cast("bigint").alias(rule.name) for rule in plain)), watch


def report_with(df: DataFrame, dataset: str, rules: Iterable[Rule], seen: Mapping[str, int]) -> DataFrame:
    """The report of ``quality_report`` where some numbers were ``seen`` while ``df`` was written.

    The rows are looked at again only for rules that are neither seen nor known, such as a count of distinct ids.
    """
    rules = [replace(rule, known=seen[rule.name]) if rule.name in seen else rule for rule in rules]
    settled, open_rules = ([rule for rule in rules if (rule.known is not None) is known] for known in (True, False))
    rows = [(dataset, rule.name, rule.known) for rule in settled]
    known = df.sparkSession.createDataFrame(rows, "dataset string, rule string, observed bigint")
    report = known.select("dataset", "rule", "observed", _passed(settled).alias("passed"))
    return report.unionByName(quality_report(df, dataset, open_rules)) if open_rules else report


def quality_by(df: DataFrame, dataset: str, rules: Iterable[Rule]) -> DataFrame:
    """The same for every dataset that the column ``dataset`` names, in one scan."""
    rules = list(rules)
    numbers = df.groupBy(F.expr(quoted(dataset)).alias("dataset")).agg(*(rule.observed.cast("bigint").alias(rule.name) for rule in rules))
    return _verdicts(numbers, rules)


def _verdicts(numbers: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = numbers.unpivot(["dataset"], [rule.name for rule in rules], "rule", "observed")
    return rows.select("dataset", "rule", "observed", _passed(rules).alias("passed"))


def _passed(rules: list[Rule]) -> Column:
    return reduce(
        lambda verdict, rule: F.when(F.col("rule") == rule.name, rule.passes(F.col("observed"))).otherwise(verdict),
        rules,
        F.lit(None).cast("boolean"),
    )


def require_passed(report: DataFrame) -> None:
    """Raise when a rule failed. Optional: by default a report informs and nothing stops."""
    failed = report.where(~F.col("passed")).orderBy("dataset", "rule").collect()
    if failed:
        raise ValueError("quality rules failed: " + ", ".join(f"{r.dataset}/{r.rule}={r.observed}" for r in failed))
