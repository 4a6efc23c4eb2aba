"""Gold: the fifteen market questions over the unified survey table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from tallyloom.catalog.answers import (
    AI_PRIORITY_FOLD,
    GAP_BASE,
    GAP_OTHER,
    LANGUAGE_FLAGS,
    ROLE_FOLD,
    TECHNOLOGY_FLAGS,
    WORK_MODEL_FOLD,
)
from tallyloom.catalog.editions import EDITION_COLUMN as EDITION
from tallyloom.catalog.editions import EDITIONS
from tallyloom.functions import fold_label
from tallyloom.operators.measures import (
    COUNT,
    MEAN,
    SHARE,
    flag_adoption,
    flag_profile,
    mean_by,
    ordered,
    share,
    share_and_mean,
)
from tallyloom.session import run_together
from tallyloom.sources.results import write_result

PAY = "faixa_salarial_media"
MIN_GROUP = 15

_SHARE = f"{COUNT} bigint, {SHARE} double"
_PAY = f"{MEAN} double, {COUNT} bigint"


@dataclass(frozen=True)
class Question:
    """A measure of the unified table, and how its result is laid out, ordered and cut."""

    asks: str
    measure: Callable[[DataFrame], DataFrame]
    schema: str
    order: tuple[str, ...]
    top: int | None = None

    @property
    def columns(self) -> list[str]:
        return [field.split()[0] for field in self.schema.split(", ")]


QUESTIONS: dict[str, Question] = {
    "role_share": Question(
        "1a: the 15 most common job titles",
        lambda silver: share(silver, "cargo_atual"),
        f"cargo_atual string, {_SHARE}",
        (f"-{COUNT}", "cargo_atual"),
        top=15,
    ),
    "seniority_by_edition": Question(
        "1b: seniority mix of each edition",
        lambda silver: share(silver, "senioridade", within=EDITION, groups=EDITIONS),
        f"senioridade string, {EDITION} string, {_SHARE}",
        (EDITION, f"-{COUNT}", "senioridade"),
    ),
    "sector_share": Question(
        "1c: the 10 most common company sectors",
        lambda silver: share(silver, "setor"),
        f"setor string, {_SHARE}",
        (f"-{COUNT}", "setor"),
        top=10,
    ),
    "work_model_by_edition": Question(
        "1d: work models of each edition",
        lambda silver: share(silver, "modelo_trabalho_atual", within=EDITION, groups=EDITIONS),
        f"modelo_trabalho_atual string, {EDITION} string, {_SHARE}",
        (EDITION, f"-{COUNT}", "modelo_trabalho_atual"),
    ),
    "role_seniority_pay": Question(
        "2a: the 15 best-paid pairs of title and seniority with enough answers",
        lambda silver: mean_by(silver, ["cargo_atual", "senioridade"], PAY, MIN_GROUP),
        f"cargo_atual string, senioridade string, {_PAY}",
        (f"-{MEAN}", "cargo_atual", "senioridade"),
        top=15,
    ),
    "seniority_edition_pay": Question(
        "2b: mean pay by seniority over the editions",
        lambda silver: mean_by(silver, ["senioridade", EDITION], PAY),
        f"senioridade string, {EDITION} string, {_PAY}",
        ("senioridade", EDITION),
    ),
    "company_size_pay": Question(
        "2c: mean pay by company size",
        lambda silver: mean_by(silver, ["numero_funcionarios"], PAY, MIN_GROUP),
        f"numero_funcionarios string, {_PAY}",
        (f"-{MEAN}", "numero_funcionarios"),
    ),
    "language_count_pay": Question(
        "2d: mean pay by number of languages, those who did not answer being a group of their own",
        lambda silver: flag_profile(silver, LANGUAGE_FLAGS, PAY, "qtd_linguagens", MIN_GROUP),
        f"qtd_linguagens int, {_PAY}",
        ("qtd_linguagens",),
    ),
    "gender_by_edition": Question(
        "3a: gender mix of each edition",
        lambda silver: share(silver, "genero", within=EDITION, groups=EDITIONS),
        f"{EDITION} string, genero string, {_SHARE}",
        (EDITION, f"-{SHARE}", f"-{COUNT}", "genero"),
    ),
    "ethnicity_by_edition": Question(
        "3b: race and ethnicity mix of each edition",
        lambda silver: share(silver, "cor_raca_etnia", within=EDITION, groups=EDITIONS),
        f"{EDITION} string, cor_raca_etnia string, {_SHARE}",
        (EDITION, f"-{SHARE}", f"-{COUNT}", "cor_raca_etnia"),
    ),
    "gender_seniority_pay": Question(
        "3c: mean pay of two genders at the same seniority",
        lambda silver: mean_by(silver, ["senioridade", "genero"], PAY, only={"genero": (GAP_BASE, GAP_OTHER)}),
        f"senioridade string, genero string, {_PAY}",
        ("senioridade", "genero"),
    ),
    "ethnicity_seniority_pay": Question(
        "3d: mean pay by race and ethnicity at the same seniority",
        lambda silver: mean_by(silver, ["senioridade", "cor_raca_etnia"], PAY, MIN_GROUP),
        f"senioridade string, cor_raca_etnia string, {_PAY}",
        ("senioridade", f"-{MEAN}", "cor_raca_etnia"),
    ),
    "technology_adoption": Question(
        "4: respondents using each technology",
        lambda silver: flag_adoption(silver, TECHNOLOGY_FLAGS, "tecnologia", "total_usuarios"),
        "tecnologia string, total_usuarios bigint",
        ("-total_usuarios", "tecnologia"),
    ),
    "ai_priority": Question(
        "5: how much of a priority generative AI is, with mean pay",
        lambda silver: share_and_mean(silver, "ia_prioridade_empresa", PAY),
        f"ia_prioridade_empresa string, {_SHARE}, {MEAN} double",
        (f"-{COUNT}", "ia_prioridade_empresa"),
    ),
    "region_pay": Question(
        "6: mean pay by region",
        lambda silver: mean_by(silver, ["regiao_onde_mora"], PAY, MIN_GROUP),
        f"regiao_onde_mora string, {_PAY}",
        (f"-{MEAN}", "regiao_onde_mora"),
    ),
}


def fold_answers(silver: DataFrame) -> DataFrame:
    """Drifted wording folded before any question is asked, rather than in the charts after it.

    A cut to the most common answers then counts all wordings of one answer together.
    """
    folds = {"cargo_atual": ROLE_FOLD, "modelo_trabalho_atual": WORK_MODEL_FOLD, "ia_prioridade_empresa": AI_PRIORITY_FOLD}
    return silver.withColumns({column: fold_label(column, labels) for column, labels in folds.items()})


def answer(name: str, silver: DataFrame, in_order: bool = True) -> DataFrame:
    """The result of one question.

    ``in_order=False`` spares the sort where a further step does not care; a cut to the
    top rows is part of the question and always made.
    """
    question = QUESTIONS[name]
    result = question.measure(silver).select(*question.columns)
    if in_order or question.top is not None:
        return ordered(result, *question.order, top=question.top)
    return result


def export_gold(silver: DataFrame, folder: str, concurrency: int = 4) -> dict[str, str]:
    """Answer every question and export each result; returns the folder of each.

    Each question scans only its own few columns, so together they read less than one
    persisted copy of the whole wide table would take to build.
    """
    targets = {name: f"{folder.rstrip('/')}/{name}" for name in QUESTIONS}

    def export(name: str) -> None:
        write_result(answer(name, silver), targets[name])

    run_together(silver.sparkSession, (partial(export, name) for name in QUESTIONS), concurrency)
    return targets
