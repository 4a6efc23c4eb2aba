"""Bronze: raw exports landed as Parquet tables, with a quality report beside them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.headers import sanitize_columns
from tallyloom.operators.quality import Rule, has_columns, observed, one_header, report_with, require_passed
from tallyloom.sources.results import read_result, write_result
from tallyloom.sources.survey_csv import header_layouts, read_survey_csv, scanned
from tallyloom.sources.tables import drop_folder, new_build, publish, register_folder

Rules = Callable[[DataFrame], Iterable[Rule]]


def default_rules(df: DataFrame) -> list[Rule]:
    return [has_columns(df)]


@dataclass(frozen=True)
class Landed:
    """An edition that lies aside, written and not yet published."""

    table: str
    root: str
    build: str
    rows: DataFrame
    headers: int
    seen: dict[str, int]


def land_aside(
    spark: SparkSession,
    folder: str,
    table: str,
    root: str,
    clean_names: bool = False,
    record_end: str | None = None,
    dedupe: bool = False,
    rules: Rules = default_rules,
) -> Landed:
    """Write one edition as Parquet into a folder that no table names yet.

    Rules that are plain aggregates are observed by the write. Names stay raw unless ``clean_names``. ``dedupe`` drops rows that repeat another in every column, as
    an edition delivered twice has; by default they stay and the report shows them.
    """
    ranges = scanned(spark, folder)
    raw = read_survey_csv(spark, folder, record_end, ranges)
    rows = raw.dropDuplicates() if dedupe else raw
    build = new_build(root)
    rows = sanitize_columns(rows) if clean_names else rows
    rows, watch = observed(rows, rules(rows))
    rows.write.option("compression", "snappy").parquet(build)
    headers = len({header for header, _ in header_layouts(ranges).values()})
    return Landed(table, root, build, spark.read.parquet(build), headers, watch.get if watch else {})


def report_on(landed: Landed, rules: Rules) -> DataFrame:
    """The quality report of an edition that lies aside; only what its write did not observe is counted anew."""
    return report_with(landed.rows, landed.table, [one_header(landed.headers), *rules(landed.rows)], landed.seen)


def keep_report(report: DataFrame, folder: str) -> None:
    """Add a report to the history of all evaluations, with its time."""
    report.withColumn("evaluated_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(folder)


def publish_landed(spark: SparkSession, landed: Landed) -> DataFrame:
    """Publish what lies aside as the edition's present version, and point its table there."""
    publish(spark, landed.root, landed.build)
    return register_folder(spark, landed.table, landed.build)


def land_edition(
    spark: SparkSession,
    folder: str,
    table: str,
    location: str,
    clean_names: bool = False,
    rules: Rules = default_rules,
    gate: bool = False,
    record_end: str | None = None,
    dedupe: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Land one edition and report on it: (table, quality report).

    The table is replaced, so landing an edition again does not double it. The report is written to
    ``<location>/quality`` in any case, once, read back, and added to ``<location>/quality-history``. It informs only, unless ``gate``: then a
    failed rule leaves the earlier table as it was.
    """
    landed = land_aside(spark, folder, table, location, clean_names, record_end, dedupe, rules)
    report = report_on(landed, rules)
    write_result(report, f"{location}/quality")
    report = read_result(spark, f"{location}/quality", report.schema)
    keep_report(report, f"{location}/quality-history")
    if gate:
        try:
            require_passed(report)
        except ValueError:
            drop_folder(spark, landed.build)
            raise
    return publish_landed(spark, landed), report
