"""Gold questions against published results, rebuilt from their own counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import expected
from tallyloom.operators.conform import SILVER_SCHEMA
from tallyloom.operators.measures import ordered
from tallyloom.plans.gold import MIN_GROUP, QUESTIONS, answer, fold_answers


def respondents(spark, columns, counted):
    """A Silver table with as many rows as each published row counts."""
    counts = spark.createDataFrame(counted, ", ".join(f"{c} string" for c in columns) + ", n bigint")
    rows = counts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    missing = [f.name for f in SILVER_SCHEMA if f.name not in columns]
    types = {f.name: f.dataType for f in SILVER_SCHEMA}
    return rows.select(*columns, *(F.lit(None).cast(types[c]).alias(c) for c in missing)).select(*SILVER_SCHEMA.names)


def result(name, silver):
    return [tuple(row) for row in answer(name, silver).collect()]


def test_there_are_fifteen_questions():
    assert len(QUESTIONS) == 15
    assert [q.asks.split(":")[0] for q in QUESTIONS.values()] == "1a 1b 1c 1d 2a 2b 2c 2d 3a 3b 3c 3d 4 5 6".split()


def test_role_share_is_of_everyone_not_of_the_top(spark):
    # 206 respondents hold titles below the cut; they still count in the whole.
    others = [(f"cargo raro {i:02d}", 2) for i in range(103)]
    counted = [(role, total) for role, total, _ in expected.ROLE_SHARE] + others
    assert result("role_share", respondents(spark, ["cargo_atual"], counted)) == expected.ROLE_SHARE


def test_wording_can_be_folded_before_the_cut(spark):
    counted = [(role, total) for role, total, _ in expected.ROLE_SHARE] + [("cargo raro", 70)]
    rows = result("role_share", fold_answers(respondents(spark, ["cargo_atual"], counted)))
    assert rows[2][:2] == ("Engenheiro de Dados/Data Engineer/Data Architect", 1368 + 1015)
    assert rows[-1][:2] == ("cargo raro", 70) and len(rows) == 15


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("seniority_by_edition", ["senioridade", "ano_pesquisa"]),
        ("work_model_by_edition", ["modelo_trabalho_atual", "ano_pesquisa"]),
        ("gender_by_edition", ["ano_pesquisa", "genero"]),
        ("ethnicity_by_edition", ["ano_pesquisa", "cor_raca_etnia"]),
    ],
)
def test_shares_by_edition(spark, name, columns):
    published = expected.GOLD[name]
    # Missing answers are not part of any share.
    unanswered = [tuple("2023_2024" if c == "ano_pesquisa" else None for c in columns) + (500,)]
    silver = respondents(spark, columns, [row[:3] for row in published] + unanswered)
    assert result(name, silver) == published


def test_sector_share(spark):
    # 3025 respondents work in sectors below the cut.
    others = [(f"setor raro {i:02d}", 55) for i in range(55)]
    counted = [(sector, total) for sector, total, _ in expected.SECTOR_SHARE] + others
    assert result("sector_share", respondents(spark, ["setor"], counted)) == expected.SECTOR_SHARE


@pytest.mark.parametrize("name", ["company_size_pay", "seniority_edition_pay", "ethnicity_seniority_pay", "role_seniority_pay", "region_pay"])
def test_published_pay_is_in_the_order_of_its_question(spark, name):
    question, published = QUESTIONS[name], expected.GOLD[name]
    shuffled = spark.createDataFrame(sorted(published, key=str, reverse=True), question.schema)
    assert [tuple(row) for row in ordered(shuffled, *question.order).collect()] == published
    totals = [row[question.columns.index("total")] for row in published]
    assert min(totals) >= MIN_GROUP


def test_an_edition_that_is_not_listed_is_an_error(spark):
    silver = respondents(spark, ["senioridade", "ano_pesquisa"], [("Pleno", "1999_2000", 3), ("Pleno", "2023_2024", 3)])
    with pytest.raises(Exception, match="ano_pesquisa is not listed: 1999_2000"):
        result("seniority_by_edition", silver)


def test_ai_priority_shares(spark):
    counted = [row[:2] for row in expected.AI_PRIORITY]
    rows = result("ai_priority", respondents(spark, ["ia_prioridade_empresa"], counted))
    assert [row[:3] for row in rows] == [row[:3] for row in expected.AI_PRIORITY]
    assert all(row[3] is None for row in rows)


def test_technology_adoption(spark):
    flags = {"SQL": "lang_sql", "Julia": "lang_julia"}
    silver = respondents(spark, list(flags.values()), [("1", "0", 5), ("1", "1", 2), (None, None, 9)])
    assert result("technology_adoption", silver)[:2] == [("SQL", 7), ("Julia", 2)]


def test_results_have_their_declared_schema(spark):
    empty = spark.createDataFrame([], SILVER_SCHEMA)
    for name, question in QUESTIONS.items():
        declared = spark.createDataFrame([], question.schema).schema
        got = answer(name, empty).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared], name
