"""Raw exports to Bronze, Silver, Gold and charts."""

from __future__ import annotations

import os
import re
import threading
import time

import pytest
from pyspark import inheritable_thread_target

from survey_fixture import RESPONDENTS, write_all, write_raw
from tallyloom.__main__ import main
from tallyloom.catalog.answers import SALARY_MIDPOINTS
from tallyloom.catalog.editions import RAW_COLUMNS, SILVER_COLUMNS
from tallyloom.functions import midpoint
from tallyloom.operators.conform import conform_edition, map_edition, resolve_columns, unify
from tallyloom.operators.headers import clean_name, column_lineage, sanitize_columns
from tallyloom.operators.quality import edition_rules, observed, quality_report, report_with, require_passed
from tallyloom.plans.bronze import land_edition
from tallyloom.plans.gold import QUESTIONS, answer
from tallyloom.plans.run import read_gold, run_bronze, run_charts, run_gold, run_silver
from tallyloom.plans.silver import create_silver, open_silver, read_silver, read_version, refresh_edition, refresh_silver, replace_edition
from tallyloom.plans.states import answer_from_states, read_states, replace_states, survey_states, write_states
from tallyloom.sources.survey_csv import read_survey_csv
from tallyloom.sources.tables import present


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folders = write_all(str(tmp_path_factory.mktemp("raw")))
    return {edition: read_survey_csv(spark, folder) for edition, folder in folders.items()}


@pytest.fixture(scope="module")
def silver(raw):
    return {row.id_respondente: row for row in unify(raw).collect()}


def test_catalog_is_consistent():
    mapped = [name for name in SILVER_COLUMNS if name not in ("faixa_salarial_media", "ano_pesquisa")]
    assert all(list(columns) == [*dict.fromkeys(columns)] for columns in RAW_COLUMNS.values())
    assert all(sorted(columns) == sorted(mapped) for columns in RAW_COLUMNS.values())
    assert len(SILVER_COLUMNS) == 36
    assert len(SALARY_MIDPOINTS) == 15 and len(set(SALARY_MIDPOINTS.values())) == 13


def test_silver_schema(raw):
    unified = unify(raw)
    assert tuple(unified.columns) == SILVER_COLUMNS
    kinds = {field.name: field.dataType.simpleString() for field in unified.schema}
    assert {name for name, kind in kinds.items() if kind != "string"} == {"faixa_salarial_media"}
    assert kinds["faixa_salarial_media"] == "double"


def test_silver_rows(silver):
    assert sorted(silver) == ["a1", "a2", "b1", "b2", "c1", "c2", "c3"]
    assert [silver[i].ano_pesquisa for i in ("a1", "b1", "c1")] == list(RESPONDENTS)
    assert silver["a1"].motivo_insatisfacao == 'Falta "plano",\nsem retorno '
    assert silver["a1"].idade == "30" and silver["a2"].idade is None
    assert silver["c1"].modelo_trabalho_atual == "Modelo 100% remoto"
    assert silver["b1"].lang_vb_vba == "1" and silver["c1"].lang_rust == "1"
    assert silver["b1"].lang_sql is None


def test_midpoints(silver):
    pay = {i: row.faixa_salarial_media for i, row in silver.items()}
    assert pay == {"a1": 1500.5, "a2": None, "b1": 27500.5, "b2": 45000.0, "c1": None, "c2": 500.0, "c3": 500.0}


def test_truth(silver):
    satisfied = {i: row.satisfeito_empresa for i, row in silver.items()}
    assert satisfied == {"a1": "Sim", "a2": "Nao", "b1": "Sim", "b2": "Nao", "c1": None, "c2": "Nao", "c3": "Sim"}


def test_labels_with_quotes_and_backslashes(spark):
    odd = {"it's": 1.0, "a\\b": 2.0, 'say "x"': 3.5}
    df = spark.createDataFrame([(label,) for label in [*odd, None]], "`an odd.name` string")
    rows = df.select("`an odd.name`", midpoint("an odd.name", odd).alias("m")).collect()
    assert {row[0]: row.m for row in rows} == odd | {None: None}


def test_drifted_columns_are_reported(raw):
    present = raw["2024_2025"].columns
    with pytest.raises(ValueError, match="setor.*2.b_setor"):
        resolve_columns([c for c in present if c != "2.b_setor"], RAW_COLUMNS["2024_2025"])
    with pytest.raises(ValueError, match="setor.*2.b_setor.*2_b_setor"):
        resolve_columns([*present, "2_b_setor"], RAW_COLUMNS["2024_2025"])


def test_landing_keeps_raw_names_or_cleans_them(spark, tmp_path):
    folder = write_raw(str(tmp_path / "raw"), "2023_2024")
    landed, report = land_edition(spark, folder, "bronze_raw_names", str(tmp_path / "a"))
    raw_names = list(RAW_COLUMNS["2023_2024"].values())
    assert landed.columns[: len(raw_names)] == raw_names
    assert spark.catalog.tableExists("bronze_raw_names")
    assert sorted(tuple(r) for r in report.collect()) == [
        ("bronze_raw_names", "column_count", len(landed.columns), True),
        ("bronze_raw_names", "header_variants", 1, True),
    ]

    cleaned, _ = land_edition(spark, folder, "bronze_clean_names", str(tmp_path / "b"), clean_names=True)
    assert cleaned.columns[: len(raw_names)] == [clean_name(name) for name in raw_names]
    same = conform_edition(landed, "2023_2024")
    assert sorted(conform_edition(cleaned, "2023_2024").collect()) == sorted(same.collect())


def test_landing_twice_doubles_nothing(spark, tmp_path):
    folder = write_raw(str(tmp_path / "raw"), "2025_2026")
    for _ in range(2):
        landed, _ = land_edition(spark, folder, "bronze_again", str(tmp_path / "again"))
    assert spark.table("bronze_again").count() == 3


def test_quality_flags_a_doubled_edition(spark, tmp_path):
    folder = write_raw(str(tmp_path), "2024_2025")
    write_raw(str(tmp_path), "2024_2025", "part/copy.csv")
    raw = read_survey_csv(spark, folder)
    report = quality_report(raw, "twice", edition_rules(raw, RAW_COLUMNS["2024_2025"]))
    rows = {row.rule: (row.observed, row.passed) for row in report.collect()}
    assert rows["duplicate_ids"] == (2, False)
    assert rows["column_count"][1] and rows["unknown_salary_bands"] == (0, True)
    with pytest.raises(ValueError, match="twice/duplicate_ids=2"):
        require_passed(report)


def test_quality_flags_unknown_answers(spark, raw):
    rules = edition_rules(raw["2023_2024"], RAW_COLUMNS["2023_2024"])
    rows = {row.rule: row.observed for row in quality_report(raw["2023_2024"], "first", rules).collect()}
    assert rows["unknown_salary_bands"] == 1 and rows["bad_language_flags"] == 0 and rows["duplicate_ids"] == 0


def test_rules_are_observed_by_the_write(spark, raw, tmp_path):
    edition = "2023_2024"
    rules = edition_rules(raw[edition], RAW_COLUMNS[edition])
    watched, watch = observed(raw[edition], rules)
    watched.write.parquet(str(tmp_path / "p"))
    assert set(watch.get) == {"unknown_salary_bands", "bad_language_flags"}
    written = spark.read.parquet(str(tmp_path / "p"))
    expected = sorted(map(tuple, quality_report(written, "x", rules).collect()))
    assert sorted(map(tuple, report_with(written, "x", rules, watch.get).collect())) == expected
    plain = report_with(written, "x", [rule for rule in rules if rule.plain], watch.get)
    assert "FileScan" not in plain._jdf.queryExecution().executedPlan().toString()
    assert observed(written, []) == (written, None)


def test_every_evaluation_is_kept(spark, tmp_path):
    folder = write_raw(str(tmp_path / "raw"), "2024_2025")
    for _ in range(2):
        land_edition(spark, folder, "bronze_history", str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h/quality-history"))
    assert history.count() == 4 and history.select("evaluated_at").distinct().count() == 2


def test_gate_stops_landing(spark, tmp_path):
    folders = {"2023_2024": write_raw(str(tmp_path / "raw"), "2023_2024")}
    with pytest.raises(ValueError, match="unknown_salary_bands=1"):
        run_bronze(spark, folders, str(tmp_path / "w"), gate=True)
    assert run_bronze(spark, folders, str(tmp_path / "w")).where("not passed").count() == 1


def test_a_failing_edition_leaves_earlier_tables_and_a_report(spark, tmp_path):
    warehouse = str(tmp_path / "w")
    good = {"2024_2025": write_raw(str(tmp_path / "good"), "2024_2025"), "2025_2026": write_raw(str(tmp_path / "good"), "2025_2026")}
    run_bronze(spark, good, warehouse, gate=True)
    doubled = dict(good)
    write_raw(str(tmp_path / "good"), "2024_2025", "part/copy.csv")
    write_raw(str(tmp_path / "good"), "2025_2026", "part/copy.csv")
    with pytest.raises(ValueError, match="2024_2025/duplicate_ids=2.*2025_2026/duplicate_ids=3"):
        run_bronze(spark, doubled, warehouse, gate=True)
    report = spark.read.csv(f"{warehouse}/quality", header=True)
    assert report.where("passed = 'false'").count() == 2
    assert spark.table("bronze_survey_2024_2025").count() == 2 and spark.table("bronze_survey_2025_2026").count() == 3
    assert len(list((tmp_path / "w/bronze/2024_2025").glob("build-*"))) == 1
    run_bronze(spark, doubled, warehouse, gate=True, dedupe=True)
    assert spark.table("bronze_survey_2024_2025").count() == 2


def test_files_of_an_edition_that_drift_are_reported(spark, tmp_path):
    folder = write_raw(str(tmp_path), "2024_2025")
    with pytest.raises(ValueError, match="headers differ"):  # the fixture's doubled header is then unclear
        (tmp_path / "2024_2025/part/more.csv").write_text("0.a_token\nz\n")
        land_edition(spark, folder, "bronze_drift", str(tmp_path / "l"))
    for path in (tmp_path / "2024_2025/part").glob("*.csv"):
        path.write_text(path.read_text().replace("9.z_outra_pergunta,9.z_outra_pergunta", "9.y,9.z", 1))
    landed, report = land_edition(spark, folder, "bronze_drift", str(tmp_path / "l"))
    assert landed.count() == 3 and {r.rule: r.observed for r in report.collect()}["header_variants"] == 2


def test_cleaned_columns_remember_their_raw_names(spark, tmp_path):
    df = spark.createDataFrame([("other", "right", "x")], "`2.b-setor` string, `2.b_setor` string, id string")
    cleaned = sanitize_columns(df)
    assert column_lineage(cleaned.schema) == [(0, "2.b-setor", "2_b_setor"), (1, "2.b_setor", "2_b_setor_1"), (2, "id", "id")]
    cleaned.write.parquet(str(tmp_path / "p"))
    for frame in (cleaned, spark.read.parquet(str(tmp_path / "p"))):
        assert resolve_columns(frame.schema, {"setor": "2.b_setor"}) == {"setor": "2_b_setor_1"}
        assert map_edition(frame, {"setor": "2.b_setor"}).first().setor == "right"
    with pytest.raises(ValueError, match="2_b_setor_1"):
        resolve_columns(cleaned.columns, {"setor": "2.b_setor"})


def test_catalog_meets_the_fixture_table():
    """The table of fixtures was taken from the survey's own mapping, the catalog was typed."""
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")
    rows = [line.strip().strip("|").split(" | ") for line in open(path, encoding="utf-8") if re.match(r"\| \d+ \| `", line)]
    mapped = {row[1].strip(" `"): [cell.strip(" `") for cell in row[2:5]] for row in rows if len(row) == 6}
    mapped = {name: raw for name, raw in mapped.items() if name in RAW_COLUMNS["2023_2024"]}
    assert len(mapped) == 34
    for number, edition in enumerate(RAW_COLUMNS):
        assert {name: raw[number] for name, raw in mapped.items()} == dict(RAW_COLUMNS[edition])


def test_silver_is_replaced_as_a_whole_or_by_edition(spark, raw, tmp_path):
    location = str(tmp_path / "silver")
    refresh_silver(raw, location)
    refresh_edition(raw["2024_2025"].limit(1), "2024_2025", location)
    refresh_silver({"2025_2026": raw["2025_2026"]}, location)
    counts = dict(read_silver(spark, location).groupBy("ano_pesquisa").count().collect())
    assert counts == {"2023_2024": 2, "2024_2025": 1, "2025_2026": 3}

    root = str(tmp_path / "built")
    table = create_silver(raw, "silver_replaced", root)
    assert table.count() == 7 and tuple(table.columns) == SILVER_COLUMNS
    fewer = create_silver({"2025_2026": raw["2025_2026"]}, "silver_replaced", root)
    assert fewer.count() == 3 and spark.table("silver_replaced").count() == 3
    assert len(list((tmp_path / "built").glob("build-*"))) == 2  # the earlier one stays for its readers
    spark.sql("drop table silver_replaced")  # as in a later session, whose catalog is empty
    assert open_silver(spark, "silver_replaced", root).count() == 3
    with pytest.raises(FileNotFoundError):
        open_silver(spark, "silver_replaced", str(tmp_path / "nowhere"))


def test_one_edition_of_a_published_table_is_replaced(spark, raw, tmp_path):
    root, name = str(tmp_path / "built"), "silver_by_edition"
    with pytest.raises(FileNotFoundError):
        replace_edition(raw["2024_2025"], "2024_2025", name, root)
    create_silver({edition: raw[edition] for edition in ("2023_2024", "2024_2025")}, name, root)
    assert replace_edition(raw["2025_2026"], "2025_2026", name, root).count() == 7
    others = sorted((tmp_path / "built").rglob("ano_pesquisa=2023_2024/*.parquet"))
    stamps = [path.stat().st_mtime_ns for path in others]

    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(name).where("ano_pesquisa = '2024_2025'").count())

    reader = threading.Thread(target=inheritable_thread_target(spark)(read))
    reader.start()
    try:
        version = present(spark, root)
        replaced = replace_edition(raw["2024_2025"].limit(1), "2024_2025", name, root)
    finally:
        time.sleep(1)
        stop.set()
        reader.join()
    assert replaced.count() == 6 and set(seen) == {2, 1} and sorted(seen, reverse=True) == seen
    assert read_version(spark, root, version).count() == 7
    assert [path.stat().st_mtime_ns for path in others] == stamps
    spark.sql(f"drop table {name}")
    assert dict(open_silver(spark, name, root).groupBy("ano_pesquisa").count().collect()) == {"2023_2024": 2, "2024_2025": 1, "2025_2026": 3}


def test_questions_from_kept_states(spark, raw, tmp_path):
    root, silver_at = str(tmp_path / "states"), str(tmp_path / "silver")
    refresh_silver(raw, silver_at)
    silver = read_silver(spark, silver_at)
    many = silver.crossJoin(spark.range(17)).drop("id")

    def answers(ask, source):
        return {name: [tuple(row) for row in ask(name, source).collect()] for name in QUESTIONS}

    write_states(many, ["2023_2024", "2024_2025"], root)
    with pytest.raises(FileNotFoundError):
        replace_states(many, "2024_2025", str(tmp_path / "nowhere"))
    replace_states(many, "2025_2026", root)
    expected = answers(answer, many)
    assert answers(answer_from_states, read_states(spark, root)) == expected
    assert sum(map(len, expected.values())) > 15
    # Another edition of the survey: one scan, and of that edition alone.
    fewer = many.where("ano_pesquisa <> '2024_2025' or genero is not null").where("ano_pesquisa <> '2024_2025' or id_respondente is not null")
    plan = survey_states(silver.where("ano_pesquisa = '2024_2025'"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and re.search(r"PartitionFilters: \[[^]]*ano_pesquisa#\d+ = 2024_2025", plan)
    replace_states(fewer, "2024_2025", root)
    assert answers(answer_from_states, read_states(spark, root)) == answers(answer, fewer)


def test_whole_flow(spark, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    run_bronze(spark, write_all(str(tmp_path / "raw")), warehouse)
    assert run_silver(spark, warehouse).count() == 7
    assert sorted(run_gold(spark, warehouse)) == sorted(QUESTIONS)
    gold = read_gold(spark, warehouse)
    technologies = {row.tecnologia: row.total_usuarios for row in gold["technology_adoption"].collect()}
    assert technologies["SQL"] == 1 and technologies["Rust"] == 1 and technologies["Julia"] == 0
    assert [tuple(row) for row in gold["role_share"].collect()] == [
        ("Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect", 1, 100.0)
    ]
    assert "top_roles" in run_charts(spark, warehouse)
    assert spark.read.csv(f"{warehouse}/charts/top_roles", header=True).first().cargo_atual == (
        "Engenheiro de Dados/Data Engineer/Data Architect"
    )


def test_command_line(spark, tmp_path, capsys):
    folders = write_all(str(tmp_path / "raw"))
    raw = [f"--raw={edition}={folder}" for edition, folder in folders.items()]
    main(["all", f"--warehouse={tmp_path / 'w'}", *raw])
    assert "duplicate_ids" in capsys.readouterr().out
    assert len(read_gold(spark, str(tmp_path / "w"))) == 15
    with pytest.raises(SystemExit):
        main(["bronze", f"--warehouse={tmp_path / 'w'}", "--raw=1999=x"])
