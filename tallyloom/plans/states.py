"""The fifteen questions from kept partial states: one scan for all of them, and one edition at a time.

A state is the count of respondents, how many of them have a value, and the sum of the values, for every answer or
pair of answers that some question groups by, within an edition. States of several editions add up, so they are
stored one folder for each edition and published in versions: a replaced edition is scanned alone, and every
question is answered from the states, whose rows are as many as the answers and not as the respondents.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.answers import GAP_BASE, GAP_OTHER, LANGUAGE_FLAGS, TECHNOLOGY_FLAGS
from tallyloom.catalog.editions import EDITION_COLUMN as EDITION
from tallyloom.catalog.editions import EDITIONS
from tallyloom.functions import flag_sum, quoted
from tallyloom.operators.measures import COUNT, MEAN, SHARE, ordered, with_share
from tallyloom.plans.gold import MIN_GROUP, PAY, QUESTIONS
from tallyloom.session import run_together
from tallyloom.sources.tables import Outrun, drop_folder, new_build, overwrite_partition, partition_folder, present, publish

LANGUAGE_COUNT = "qtd_linguagens"
TECHNOLOGY = "tecnologia"

# The answers that questions group by, beside the edition.
SINGLE = ("cargo_atual", "senioridade", "setor", "modelo_trabalho_atual", "numero_funcionarios", "genero", "cor_raca_etnia", "ia_prioridade_empresa", "regiao_onde_mora")
PAIRS = (("cargo_atual", "senioridade"), ("senioridade", "genero"), ("senioridade", "cor_raca_etnia"))

STATE_SCHEMA = "grupo string, resposta string, outra string, respondentes bigint, conhecidos bigint, soma double"


def _group(first: str, second: str | None = None) -> str:
    return first if second is None else f"{first}+{second}"


def survey_states(silver: DataFrame) -> DataFrame:
    """The states of every edition in ``silver``, from one scan.

    A respondent counts once in each grouping; tasks add up their own rows before anything is shuffled, so that one row
    for each task, edition and answer is moved. Sums are exact, since values are halves or whole.
    """

    def entry(group: str, answer: Column, other: Column | None = None, value: Column | None = None) -> Column:
        missing = F.lit(None).cast("string")
        value = F.col(PAY) if value is None else value
        return F.struct(F.lit(group).alias("grupo"), answer.cast("string").alias("resposta"), (missing if other is None else other).alias("outra"), value.cast("double").alias("valor"))

    entries = [entry(name, F.col(name)) for name in SINGLE]
    entries += [entry(_group(*pair), F.col(pair[0]), F.col(pair[1])) for pair in PAIRS]
    entries.append(entry(LANGUAGE_COUNT, flag_sum(LANGUAGE_FLAGS)))
    entries += [entry(TECHNOLOGY, F.lit(label), value=F.expr(f"cast({quoted(flag)} as int)")) for label, flag in TECHNOLOGY_FLAGS.items()]
    rows = silver.select(EDITION, F.inline(F.array(*entries)))
    sums = (F.count("*").alias("respondentes"), F.count("valor").alias("conhecidos"), F.sum("valor").alias("soma"))
    return rows.groupBy(EDITION, "grupo", "resposta", "outra").agg(*sums)


def write_states(silver: DataFrame, editions: Sequence[str], location: str) -> None:
    """Publish the states of exactly these editions below ``location``; each is scanned once."""
    _publish(silver, editions, location, {}, None)


def replace_states(silver: DataFrame, edition: str, location: str) -> None:
    """Replace, or add, the states of one edition: only that edition of ``silver`` is scanned."""
    version = present(silver.sparkSession, location)
    if version is None:
        raise FileNotFoundError(f"no states were published below {location}")
    _publish(silver, [edition], location, version.parts, version.number)


def _publish(silver: DataFrame, editions: Sequence[str], location: str, parts: Mapping[str, str], after: int | None) -> None:
    spark, build = silver.sparkSession, new_build(location)

    def write(edition: str) -> None:
        overwrite_partition(survey_states(silver.where(F.col(EDITION) == edition)), build, EDITION, edition)

    run_together(spark, (partial(write, edition) for edition in editions), concurrency=max(1, len(editions)))
    own = {edition: partition_folder(build.rsplit("/", 1)[1], EDITION, edition) for edition in editions}
    try:
        publish(spark, location, build, {**parts, **own}, after)
    except Outrun:
        drop_folder(spark, build)
        raise


def read_states(spark: SparkSession, location: str) -> DataFrame:
    """The published states of all editions."""
    version = present(spark, location)
    if version is None:
        raise FileNotFoundError(f"no states were published below {location}")
    frames = [
        spark.read.schema(STATE_SCHEMA).parquet(f"{location}/{folder}").withColumn(EDITION, F.lit(edition))
        for edition, folder in version.parts.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _of(states: DataFrame, group: str, *names: str) -> DataFrame:
    """The states of a grouping under the names of its answers; without missing ones."""
    own = states.where(F.col("grupo") == group)
    columns = [F.col(source).alias(name) for source, name in zip(("resposta", "outra"), names, strict=False)]
    own = own.select(*columns, EDITION, "respondentes", "conhecidos", "soma")
    return own.dropna(subset=list(names))


def _mean(digits: int = 2) -> Column:
    return F.round(F.sum("soma") / F.nullif(F.sum("conhecidos"), F.lit(0)), digits)


def _share(answer: str, by_edition: bool = False) -> Callable[[DataFrame], DataFrame]:
    def measure(states: DataFrame) -> DataFrame:
        keys = [EDITION, answer] if by_edition else [answer]
        counts = _of(states, answer, answer).groupBy(*keys).agg(F.sum("respondentes").alias(COUNT))
        return with_share(counts, EDITION if by_edition else None, groups=EDITIONS if by_edition else None)

    return measure


def _pay(keys: Sequence[str], answers: Sequence[str], min_count: int = 1, only: Mapping[str, Sequence[str]] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Mean pay by ``keys``, from the grouping of ``answers``; only respondents whose pay is known count."""

    def measure(states: DataFrame) -> DataFrame:
        own = _of(states, _group(*answers), *answers)
        for column, listed in (only or {}).items():
            own = own.where(F.col(column).isin(*listed))
        return own.groupBy(*keys).agg(_mean().alias(MEAN), F.sum("conhecidos").alias(COUNT)).where(F.col(COUNT) >= min_count)

    return measure


def _language_count(states: DataFrame) -> DataFrame:
    own = states.where(F.col("grupo") == LANGUAGE_COUNT).groupBy(F.col("resposta").cast("int").alias(LANGUAGE_COUNT))
    return own.agg(_mean().alias(MEAN), F.sum("conhecidos").alias(COUNT)).where(F.col(COUNT) >= MIN_GROUP)


def _technologies(states: DataFrame) -> DataFrame:
    return _of(states, TECHNOLOGY, TECHNOLOGY).groupBy(TECHNOLOGY).agg(F.sum("soma").cast("bigint").alias("total_usuarios"))


def _ai_priority(states: DataFrame) -> DataFrame:
    answer = "ia_prioridade_empresa"
    own = _of(states, answer, answer).groupBy(answer).agg(F.sum("respondentes").alias(COUNT), _mean().alias(MEAN))
    return with_share(own).select(answer, COUNT, SHARE, MEAN)


MEASURES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "role_share": _share("cargo_atual"),
    "seniority_by_edition": _share("senioridade", by_edition=True),
    "sector_share": _share("setor"),
    "work_model_by_edition": _share("modelo_trabalho_atual", by_edition=True),
    "role_seniority_pay": _pay(["cargo_atual", "senioridade"], ["cargo_atual", "senioridade"], MIN_GROUP),
    "seniority_edition_pay": _pay(["senioridade", EDITION], ["senioridade"]),
    "company_size_pay": _pay(["numero_funcionarios"], ["numero_funcionarios"], MIN_GROUP),
    "language_count_pay": _language_count,
    "gender_by_edition": _share("genero", by_edition=True),
    "ethnicity_by_edition": _share("cor_raca_etnia", by_edition=True),
    "gender_seniority_pay": _pay(["senioridade", "genero"], ["senioridade", "genero"], only={"genero": (GAP_BASE, GAP_OTHER)}),
    "ethnicity_seniority_pay": _pay(["senioridade", "cor_raca_etnia"], ["senioridade", "cor_raca_etnia"], MIN_GROUP),
    "technology_adoption": _technologies,
    "ai_priority": _ai_priority,
    "region_pay": _pay(["regiao_onde_mora"], ["regiao_onde_mora"], MIN_GROUP),
}


def answer_from_states(name: str, states: DataFrame, in_order: bool = True) -> DataFrame:
    """The result of one question, as ``gold.answer`` gives it, from states alone."""
    question = QUESTIONS[name]
    result = MEASURES[name](states).select(*question.columns)
    if in_order or question.top is not None:
        return ordered(result, *question.order, top=question.top)
    return result
