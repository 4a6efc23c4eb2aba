"""The whole flow over a warehouse folder: land, conform, measure, shape."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyloom.catalog.editions import EDITIONS, RAW_COLUMNS
from tallyloom.operators.conform import resolve_columns
from tallyloom.operators.quality import Rule, edition_rules, require_passed
from tallyloom.plans.bronze import Landed, keep_report, land_aside, publish_landed, report_on
from tallyloom.plans.charts import build_charts
from tallyloom.plans.gold import QUESTIONS, export_gold, fold_answers
from tallyloom.plans.silver import create_silver, open_silver
from tallyloom.session import run_together
from tallyloom.sources.results import read_result, write_result
from tallyloom.sources.tables import drop_folder, published

SILVER_TABLE = "silver_survey"


def bronze_table(edition: str) -> str:
    return f"bronze_survey_{edition}"


def run_bronze(
    spark: SparkSession,
    folders: Mapping[str, str],
    warehouse: str,
    clean_names: bool = False,
    gate: bool = False,
    record_end: str | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """Land every edition and publish the quality report of all of them, which is returned.

    The editions land aside, at the same time. Their report is written once, whatever it says, and
    read back; with ``gate`` a failed rule of any edition stops the run with all earlier tables untouched.
    """
    landed: dict[str, Landed] = {}

    def land(edition: str) -> None:
        root = f"{warehouse}/bronze/{edition}"
        landed[edition] = land_aside(spark, folders[edition], bronze_table(edition), root, clean_names, record_end, dedupe, partial(rules, edition))

    def rules(edition: str, rows: DataFrame) -> list[Rule]:
        return edition_rules(rows, resolve_columns(rows.schema, RAW_COLUMNS[edition]))

    try:
        run_together(spark, (partial(land, edition) for edition in folders), concurrency=len(folders))
        reports = [report_on(landed[edition], partial(rules, edition)) for edition in folders]
        write_result(reduce(DataFrame.unionByName, reports), f"{warehouse}/quality")
        report = read_result(spark, f"{warehouse}/quality", reports[0].schema)
        keep_report(report, f"{warehouse}/quality-history")
        if gate:
            require_passed(report)
    except Exception:
        for edition in landed.values():
            drop_folder(spark, edition.build)
        raise
    for edition in landed.values():
        publish_landed(spark, edition)
    return report


def run_silver(spark: SparkSession, warehouse: str, table: str = SILVER_TABLE) -> DataFrame:
    """Build the unified table from the landed editions."""
    raw = {}
    for edition in EDITIONS:
        present = published(spark, f"{warehouse}/bronze/{edition}")
        if present is None:
            raise FileNotFoundError(f"edition {edition} has not been landed in {warehouse}")
        raw[edition] = spark.read.parquet(present[0])
    return create_silver(raw, table, f"{warehouse}/silver")


def run_gold(spark: SparkSession, warehouse: str, fold_labels: bool = False, table: str = SILVER_TABLE) -> dict[str, str]:
    """Answer and export every question over the Silver table, drifted wording folded beforehand if asked for."""
    silver = open_silver(spark, table, f"{warehouse}/silver")
    return export_gold(fold_answers(silver) if fold_labels else silver, f"{warehouse}/gold")


def read_gold(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The exported results that exist."""
    results = {}
    for name, question in QUESTIONS.items():
        try:
            results[name] = read_result(spark, f"{warehouse}/gold/{name}", question.schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return results


def run_charts(spark: SparkSession, warehouse: str) -> list[str]:
    """Shape and export every chart mart whose result exists."""
    marts = build_charts(read_gold(spark, warehouse))
    exports = (partial(write_result, mart, f"{warehouse}/charts/{name}") for name, mart in marts.items())
    run_together(spark, exports, concurrency=4)
    return list(marts)
