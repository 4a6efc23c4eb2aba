"""Chart marts over published results."""

from __future__ import annotations

import pytest

import expected
from tallyloom.plans import charts
from tallyloom.plans.charts import CHARTS, axis_limit, build_charts
from tallyloom.plans.gold import QUESTIONS


@pytest.fixture(scope="module")
def gold(spark):
    return {name: spark.createDataFrame(rows, QUESTIONS[name].schema) for name, rows in expected.GOLD.items()}


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_top_roles_are_folded_and_rebased(gold):
    mart = rows(charts.top_roles(gold["role_share"]))
    assert [(total, share) for _, total, share in mart][::-1] == [
        (3370, 24.4),
        (2485, 18.0),
        (2383, 17.2),
        (1623, 11.7),
        (984, 7.1),
        (715, 5.2),
        (641, 4.6),
        (438, 3.2),
        (359, 2.6),
        (278, 2.0),
        (275, 2.0),
        (117, 0.8),
    ]
    assert mart[9][0] == "Engenheiro de Dados/Data Engineer/Data Architect"


def test_seniority_matrix(gold):
    assert rows(charts.seniority_matrix(gold["seniority_by_edition"])) == [
        ("2023_2024", 27.1, 36.1, 36.8, 0.0),
        ("2024_2025", 22.7, 36.1, 41.2, 0.0),
        ("2025_2026", 20.7, 31.0, 34.3, 14.0),
    ]


def test_a_cell_given_twice_is_an_error(gold):
    doubled = gold["seniority_by_edition"].union(gold["seniority_by_edition"].limit(1))
    with pytest.raises(Exception, match="more than one percentual"):
        charts.seniority_matrix(doubled).collect()


def test_top_profiles_merge_titles(gold):
    mart = rows(charts.top_profiles(gold["role_seniority_pay"]))[::-1]
    assert [(row[4], round(row[2], 2), row[3]) for row in mart[:3]] == [
        ("Engenheiro de Machine Learning (Especialista/Staff+)", 28759.67, 27),
        ("Engenheiro de Dados (Especialista/Staff+)", 22234.31, 62),
        ("Outra Opção (Especialista/Staff+)", 21182.30, 22),
    ]
    assert len(mart) == 12
    merged = {row[4]: (round(row[2], 2), row[3]) for row in mart}
    assert merged["Engenheiro de Dados (Sênior)"] == (16785.51, 1142)
    assert mart[-1][4] == "Analista de Negócios (Especialista/Staff+)"


def test_language_count_drops_those_who_did_not_answer(gold):
    mart = rows(charts.language_count(gold["language_count_pay"]))
    assert [row[0] for row in mart] == [0, 1, 2, 3, 4, 5]
    assert mart[2] == (2, 10019.54, 7981, "2 lang.", "7.981 pes.")


@pytest.mark.parametrize("labels", [None, ["100% presencial", "100% remoto", "Modelo híbrido com dias fixos ...", "Modelo híbrido flexível (o fun..."]])
def test_work_models(gold, labels):
    mart = charts.work_models(gold["work_model_by_edition"], labels)
    assert mart.columns[1:] == ["100% presencial", "100% remoto", "Modelo híbrido com dias fixos ...", "Modelo híbrido flexível (o fun..."]
    assert rows(mart)[0] == ("2023_2024", 16.6, 46.3, 16.6, 20.5)


def test_work_models_of_two_wordings_are_summed(spark):
    schema = QUESTIONS["work_model_by_edition"].schema
    given = [("Trabalho remoto", "x", 1, 10.0), ("Modelo 100% remoto", "x", 1, 5.5), ("Trabalho presencial", "y", 2, 7.0)]
    assert rows(charts.work_models(spark.createDataFrame(given, schema))) == [("x", 0.0, 15.5), ("y", 7.0, 0.0)]


def test_work_models_that_are_folded_already_stay(spark):
    schema = QUESTIONS["work_model_by_edition"].schema
    given = spark.createDataFrame([("100% remoto", "x", 1, 10.0), ("100% presencial", "x", 2, 90.0)], schema)
    assert rows(charts.work_models(given)) == [("x", 90.0, 10.0)]


def test_a_work_model_that_is_not_listed_is_an_error(spark):
    schema = QUESTIONS["work_model_by_edition"].schema
    given = spark.createDataFrame([("100% remoto", "x", 1, 60.0), ("100% presencial", "x", 2, 40.0)], schema)
    with pytest.raises(Exception, match="modelo_curto is not listed: 100% presencial"):
        rows(charts.work_models(given, ["100% remoto"]))


def test_marts_number_their_rows(gold):
    marts = build_charts(gold)
    for name, mart in marts.items():
        positions = [row.posicao for row in mart.collect()]
        forwards = list(range(1, len(positions) + 1))
        assert positions == (forwards[::-1] if name in charts.BAR_MARTS else forwards), name
    assert marts["top_roles"].collect()[-1].cargo_atual == "Analista de Dados/Data Analyst"
    assert [row.genero for row in marts["gender_stack"].collect()[:4]] == list(charts.GENDER_ORDER)


def test_axes_of_all_marts(gold, spark):
    limits = {}
    for name in [*charts.AXES, "gender_stack"]:
        source, build = charts.CHARTS[name]
        limit = axis_limit(build(gold[source]), name)
        limits[name] = limit.select(charts.axis_text(limit.eixo_max)).first()[0]
    assert limits == {
        "top_roles": "4111.40",
        "seniority_matrix": "51.50",
        "sectors": "4254.14",
        "work_models": "57.88",
        "top_profiles": "36812.38",
        "language_count": limits["language_count"],
        "gender_gap": limits["gender_gap"],
        "technologies": "13690.84",
        "ai_priority": limits["ai_priority"],
        "regions": "14923.95",
        "gender_stack": "105.00",
    }
    wide = spark.createDataFrame([("x", 46_360_000.0, 1)], QUESTIONS["region_pay"].schema)
    limit = axis_limit(charts.regions(wide), "regions")
    assert limit.select(charts.axis_text(limit.eixo_max)).first()[0] == "57950000.00"


def test_gender_matrix_and_stack(gold):
    assert rows(charts.gender_matrix(gold["gender_by_edition"]))[0] == ("2023_2024", 75.1, 24.4, 0.2, 0.3)
    stack = rows(charts.gender_stack(gold["gender_by_edition"]))
    assert stack[:4] == [
        ("2023_2024", "Masculino", 75.1, 0.0, "75.1%"),
        ("2023_2024", "Feminino", 24.4, 75.1, "24.4%"),
        ("2023_2024", "Outro", 0.2, 99.5, None),
        ("2023_2024", "Prefiro não informar", 0.3, 99.7, None),
    ]


def test_gender_gap(gold):
    mart = charts.gender_gap(gold["gender_seniority_pay"])
    assert [(r.senioridade, r.gap_pct, r.label) for r in mart.collect()] == [
        ("Júnior", 6.1, "Gap: 6.1%"),
        ("Pleno", 1.9, "Gap: 1.9%"),
        ("Sênior", 14.4, "Gap: 14.4%"),
        ("Especialista/Staff+", 14.9, "Gap: 14.9%"),
    ]


def test_ai_priority_is_weighted_by_share(gold):
    mart = {row[0]: row[1:] for row in rows(charts.ai_priority(gold["ai_priority"]))}
    share, pay, label = mart["Iniciativa isolada (Baixa prioridade)"]
    assert (share, round(pay, 2), label) == (29.3, 18683.81, "29.3%  |  Média: R$ 18.684")
    assert rows(charts.ai_priority(gold["ai_priority"]))[-1][0] == "Iniciativa isolada (Baixa prioridade)"


def test_ai_priority_without_counts_is_averaged_plainly(gold):
    mart = {row[0]: row[2] for row in rows(charts.ai_priority(gold["ai_priority"].drop("total")))}
    assert mart["Iniciativa isolada (Baixa prioridade)"] == pytest.approx((18842.29 + 18498.34) / 2)
    unnamed = gold["ai_priority"].drop("ia_prioridade_empresa", "total")
    assert [row[0] for row in rows(charts.ai_priority(unnamed))] == ["Categoria"]


def test_a_missing_mean_shows_as_zero(spark):
    given = spark.createDataFrame([("x", 1, 40.0, None)], QUESTIONS["ai_priority"].schema)
    assert rows(charts.ai_priority(given))[0][3] == "40.0%  |  Média: R$ 0"


def test_bars_are_drawn_smallest_first(gold):
    assert rows(charts.technologies(gold["technology_adoption"])) == expected.TECHNOLOGY_ADOPTION[::-1]
    assert rows(charts.regions(gold["region_pay"])) == expected.REGION_PAY[::-1]
    assert rows(charts.sectors(gold["sector_share"])) == expected.SECTOR_SHARE[::-1]


def test_labels_and_axes(gold, spark):
    regions = charts.regions(gold["region_pay"])
    assert rows(charts.with_amount_label(regions, "salario_medio"))[-1][-1] == "R$ 11.939"
    technologies = charts.technologies(gold["technology_adoption"])
    assert rows(charts.with_count_label(technologies, "total_usuarios"))[-1][-1] == "11.222"
    assert rows(charts.with_share_label(charts.top_roles(gold["role_share"])))[-1][-1] == "24.4%"
    assert rows(axis_limit(regions, "regions")) == [(14923.95,)]
    assert rows(axis_limit(charts.seniority_matrix(gold["seniority_by_edition"]), "seniority_matrix")) == [(51.5,)]
    nothing = spark.createDataFrame([], QUESTIONS["work_model_by_edition"].schema)
    assert rows(axis_limit(charts.work_models(nothing, ["100% remoto"]), "work_models")) == [(100.0,)]


def test_optional_marts_may_lack_their_result(gold):
    assert list(build_charts(gold)) == list(CHARTS)
    fewer = {k: v for k, v in gold.items() if k not in ("ai_priority", "seniority_by_edition")}
    assert set(CHARTS) - set(build_charts(fewer)) == {"ai_priority", "seniority_matrix"}
    with pytest.raises(KeyError, match="regions"):
        build_charts({k: v for k, v in gold.items() if k != "region_pay"})
