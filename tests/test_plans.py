"""Physical plans: what is read, what is shuffled, what compiles."""

from __future__ import annotations

import re

import pytest

from survey_fixture import RESPONDENTS, write_all
from tallyloom.operators.conform import conform_edition
from tallyloom.plans.charts import CHARTS, work_models
from tallyloom.plans.gold import QUESTIONS, answer
from tallyloom.plans.silver import refresh_edition
from tallyloom.sources.survey_csv import read_survey_csv
from tallyloom.standin import landing
from tallyloom.standin.queries import WORK_MODELS, dq_report

JVM_COMPILES_UP_TO = 8000  # bytes of bytecode in one method


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def scans(df) -> int:
    """Table scans of a plan; what it uses again is in it once."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return landing.silver(spark, sf_dir)


def read_columns(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_only_needed_columns_are_read_and_filters_reach_the_scan(silver):
    plan = final_plan(answer("gender_seniority_pay", silver))
    assert plan.count("FileScan parquet") == 1
    assert {c.split(":")[0] for c in read_columns(plan)[0].split(",")} == {"genero", "senioridade", "faixa_salarial_media"}
    assert "In(genero, [Feminino,Masculino])" in plan and "IsNotNull(faixa_salarial_media)" in plan


def test_adoption_of_all_technologies_is_one_scan(silver):
    plan = final_plan(answer("technology_adoption", silver))
    assert plan.count("FileScan parquet") == 1 and "partial_sum" in plan


@pytest.mark.parametrize("name", QUESTIONS)
def test_every_question_scans_once(silver, name):
    assert scans(answer(name, silver)) == 1


@pytest.mark.parametrize("name", CHARTS)
def test_every_mart_scans_once(silver, name):
    source, build = CHARTS[name]
    labels = WORK_MODELS
    result = answer(source, silver, in_order=False)
    assert scans(work_models(result, labels) if name == "work_models" else build(result)) == 1


def test_counted_rows_are_never_dealt_by_the_edition_alone(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = answer("ethnicity_by_edition", silver, in_order=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    dealt = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\((_within|ano_pesquisa)#\d+, \d+\)", line)]
    assert len(dealt) == 1  # the wholes' own partial sums, a row per task and edition


def test_the_quality_report_scans_once(spark, sf_dir):
    plan = final_plan(dq_report(spark, sf_dir))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["role_share", "sector_share", "ai_priority", "seniority_by_edition", "gender_by_edition"])
def test_a_share_scans_once_and_gathers_nothing_in_a_window(silver, name):
    df = answer(name, silver)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The counts are shuffled once; the whole they are shares of reads that same shuffle.
    assert "ReusedExchange" in plan and "partial_count" in plan
    assert "Window" not in plan


def test_no_question_uses_a_cross_join_or_row_python(silver):
    for name in QUESTIONS:
        plan = final_plan(answer(name, silver))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas", plan), name


def test_top_rows_are_kept_per_task_not_by_a_full_sort(silver):
    assert "TakeOrderedAndProject" in final_plan(answer("role_seniority_pay", silver))


def test_one_edition_reads_one_partition(silver):
    plan = final_plan(silver.where("ano_pesquisa = '2024_2025'").select("cargo_atual"))
    assert "PartitionFilters: [isnotnull(ano_pesquisa" in plan


def test_conforming_an_edition_compiles_to_a_method_the_jvm_compiles(spark, tmp_path):
    raw = read_survey_csv(spark, write_all(str(tmp_path / "raw"))["2023_2024"])
    raw.write.parquet(str(tmp_path / "bronze"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        conformed = conform_edition(spark.read.parquet(str(tmp_path / "bronze")), "2023_2024")
        stages = conformed._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < JVM_COMPILES_UP_TO


def test_writing_an_edition_neither_shuffles_nor_sorts(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(
        "tallyloom.plans.silver.overwrite_partition",
        lambda df, *_: plans.append(df._jdf.queryExecution().executedPlan().toString()),
    )
    for edition, folder in write_all(str(tmp_path / "raw")).items():
        landed = str(tmp_path / "bronze" / edition)  # Silver reads what Bronze has landed
        read_survey_csv(spark, folder).write.parquet(landed)
        refresh_edition(spark.read.parquet(landed), edition, "unused")
    assert len(plans) == len(RESPONDENTS)
    assert not any("Exchange" in plan or "Sort" in plan for plan in plans)


def test_stand_in_is_landed_once(spark, sf_dir):
    first, second = landing.silver(spark, sf_dir), landing.silver(spark, sf_dir)
    assert first.inputFiles() == second.inputFiles()
