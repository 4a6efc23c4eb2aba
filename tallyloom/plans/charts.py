"""Chart marts: each Gold result shaped into the small table its chart draws.

A mart takes a Gold result, lazily built or read back from its export, and returns a frame
in drawing order. Labels carry the texts shown next to the marks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.catalog.answers import (
    AI_PRIORITY_FOLD,
    GAP_BASE,
    GAP_OTHER,
    GENDER_ORDER,
    ROLE_FOLD,
    SENIORITY_ORDER,
    WORK_MODEL_FOLD,
)
from tallyloom.catalog.editions import EDITION_COLUMN as EDITION
from tallyloom.functions import count_suffix, first_token, fold_label, label_with, quoted, reais, shorten, thousands
from tallyloom.operators.measures import COUNT, MEAN, RANK, SHARE, numbered, with_share
from tallyloom.operators.reshape import (
    group_gap,
    largest,
    pivot_sum,
    pivot_unique,
    plain_mean,
    rank_in,
    stack_offsets,
    weighted_mean,
)

BARS = 12

# Fixed value: where the axis of the stacked shares ends.
STACK_AXIS = 105.0
MIN_LABELLED_SHARE = 5

# Columns setting the value axis of a mart (None: all its shares), headroom above
# their largest value, and where the axis ends when there is no positive value.
AXES: dict[str, tuple[tuple[str, ...] | None, float, float | None]] = {
    "top_roles": ((COUNT,), 1.22, None),
    "seniority_matrix": (None, 1.25, 125.0),
    "sectors": ((COUNT,), 1.22, None),
    "work_models": (None, 1.25, 100.0),
    "top_profiles": ((MEAN,), 1.28, None),
    "language_count": ((MEAN,), 1.25, None),
    "gender_gap": ((GAP_BASE, GAP_OTHER), 1.25, None),
    "technologies": (("total_usuarios",), 1.22, None),
    "ai_priority": ((SHARE,), 1.62, 48.6),
    "regions": ((MEAN,), 1.25, None),
}


def top_roles(role_share: DataFrame) -> DataFrame:
    """Most common titles, drifted wording folded, shares re-based to the titles given."""
    folded = role_share.withColumn("cargo_atual", fold_label("cargo_atual", ROLE_FOLD))
    counts = folded.groupBy("cargo_atual").agg(F.sum(COUNT).alias(COUNT))
    return largest(with_share(counts, half_even=True), COUNT, "cargo_atual", BARS)


def seniority_matrix(seniority_by_edition: DataFrame) -> DataFrame:
    """Share of each seniority, one row per edition; a level absent from an edition is 0."""
    matrix = pivot_unique(seniority_by_edition, EDITION, "senioridade", SHARE, SENIORITY_ORDER)
    return matrix.na.fill(0.0).orderBy(EDITION)


def sectors(sector_share: DataFrame) -> DataFrame:
    """Sectors by respondents."""
    return largest(sector_share, COUNT, "setor")


def top_profiles(role_seniority_pay: DataFrame) -> DataFrame:
    """Best-paid profiles, titles cut to their first name and merged by respondents."""
    keys = ["cargo_atual", "senioridade"]
    short = role_seniority_pay.withColumn("cargo_atual", first_token("cargo_atual"))
    merged = weighted_mean(short, keys, MEAN, COUNT)
    labelled = merged.withColumn("label", label_with("cargo_atual", "senioridade"))
    return largest(labelled, MEAN, "label", BARS).select(*keys, MEAN, COUNT, "label")


def language_count(language_count_pay: DataFrame) -> DataFrame:
    """Pay by number of languages, without those who did not answer."""
    answered = language_count_pay.dropna(subset=["qtd_linguagens"])
    count = F.col("qtd_linguagens").cast("int")
    return (
        answered.select(
            count.alias("qtd_linguagens"),
            MEAN,
            COUNT,
            count_suffix(count, "lang.").alias("label_x"),
            F.concat(thousands(F.col(COUNT)), F.lit(" pes.")).alias("label"),
        )
        .orderBy("qtd_linguagens")
    )


def work_models(work_model_by_edition: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Share of each work model, one row per edition; wording folded or cut short."""
    answer = "modelo_trabalho_atual"
    # A label that is folded already is shown as it is.
    folds = WORK_MODEL_FOLD | {label: label for label in WORK_MODEL_FOLD.values()}
    folded = work_model_by_edition.withColumn("modelo_curto", fold_label(answer, folds, shorten(answer)))
    return pivot_sum(folded, EDITION, "modelo_curto", SHARE, labels).orderBy(EDITION)


def gender_matrix(gender_by_edition: DataFrame) -> DataFrame:
    """Share of each gender, one row per edition."""
    return pivot_unique(gender_by_edition, EDITION, "genero", SHARE, GENDER_ORDER).orderBy(EDITION)


def gender_stack(gender_by_edition: DataFrame) -> DataFrame:
    """The same as stacked segments: where each starts and, if wide enough, its label."""
    segments = stack_offsets(gender_by_edition, EDITION, "genero", SHARE, GENDER_ORDER)
    labelled = F.col("genero").isin(GAP_BASE, GAP_OTHER) & (F.col(SHARE) > MIN_LABELLED_SHARE)
    text = F.concat(F.format_number(SHARE, 1), F.lit("%"))
    return segments.withColumn("label", F.when(labelled, text))


def gender_gap(gender_seniority_pay: DataFrame) -> DataFrame:
    """Pay of two genders by seniority and the gap between them."""
    gaps = group_gap(gender_seniority_pay, "senioridade", "genero", MEAN, GAP_BASE, GAP_OTHER, SENIORITY_ORDER)
    return gaps.withColumn("label", F.concat(F.lit("Gap: "), F.format_number("gap_pct", 1), F.lit("%")))


def technologies(technology_adoption: DataFrame) -> DataFrame:
    """Technologies by users."""
    return largest(technology_adoption, "total_usuarios", "tecnologia")


def ai_priority(ai_priority: DataFrame) -> DataFrame:
    """AI priority under short labels: shares summed, pay weighted by share.

    A result without counts or pay cannot be weighted; its pay is averaged plainly.
    """
    if "ia_prioridade_empresa" in ai_priority.columns:
        label = fold_label("ia_prioridade_empresa", AI_PRIORITY_FOLD)
    else:
        label = F.lit("Categoria")
    folded = ai_priority.withColumn("rotulo_curto", label)
    merge = weighted_mean if {COUNT, MEAN} <= set(ai_priority.columns) else plain_mean
    merged = merge(folded, ["rotulo_curto"], MEAN, SHARE).withColumn(SHARE, F.round(SHARE, 1))
    text = F.concat(F.format_number(SHARE, 1), F.lit("%  |  Média: "), reais(F.col(MEAN)))
    return largest(merged.withColumn("label", text), SHARE, "rotulo_curto").select("rotulo_curto", SHARE, MEAN, "label")


def regions(region_pay: DataFrame) -> DataFrame:
    """Regions by mean pay."""
    return largest(region_pay, MEAN, "regiao_onde_mora")


def with_amount_label(mart: DataFrame, value: str, name: str = "label") -> DataFrame:
    """The amount of a bar in reais."""
    return mart.withColumn(name, reais(F.col(value)))


def with_count_label(mart: DataFrame, value: str, name: str = "label") -> DataFrame:
    """The count of a bar with dots between thousands."""
    return mart.withColumn(name, thousands(F.col(value)))


def with_share_label(mart: DataFrame, value: str = SHARE, name: str = "label") -> DataFrame:
    """The share of a bar."""
    return mart.withColumn(name, F.concat(F.col(value).cast("string"), F.lit("%")))


def axis_text(limit: Column) -> Column:
    """An axis end with two decimals, never in scientific notation."""
    return limit.cast("decimal(30,2)").cast("string")


def axis_limit(mart: DataFrame, name: str) -> DataFrame:
    """One row: where the value axis of that mart ends."""
    if name == "gender_stack":
        return mart.agg(F.lit(STACK_AXIS).alias("eixo_max"))
    columns, headroom, without_values = AXES[name]
    columns = columns or tuple(c for c in mart.columns if c not in (EDITION, RANK))
    largest_value = reduce(F.greatest, [F.max(F.col(quoted(c))) for c in columns])
    limit = F.round(largest_value * F.lit(headroom), 2)
    return mart.agg(F.when(largest_value > 0, limit).otherwise(F.lit(without_values)).alias("eixo_max"))


# Mart -> (Gold result it shapes, builder).
CHARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "top_roles": ("role_share", top_roles),
    "seniority_matrix": ("seniority_by_edition", seniority_matrix),
    "sectors": ("sector_share", sectors),
    "work_models": ("work_model_by_edition", work_models),
    "top_profiles": ("role_seniority_pay", top_profiles),
    "language_count": ("language_count_pay", language_count),
    "gender_matrix": ("gender_by_edition", gender_matrix),
    "gender_stack": ("gender_by_edition", gender_stack),
    "gender_gap": ("gender_seniority_pay", gender_gap),
    "technologies": ("technology_adoption", technologies),
    "ai_priority": ("ai_priority", ai_priority),
    "regions": ("region_pay", regions),
}

# Mart -> what its positions follow, the first position leading.
POSITIONS: dict[str, tuple[str, ...]] = {
    "top_roles": (f"-{COUNT}", "cargo_atual"),
    "seniority_matrix": (EDITION,),
    "sectors": (f"-{COUNT}", "setor"),
    "work_models": (EDITION,),
    "top_profiles": (f"-{MEAN}", "label"),
    "language_count": ("qtd_linguagens",),
    "gender_matrix": (EDITION,),
    "gender_stack": (EDITION, "_listed"),
    "gender_gap": ("_listed",),
    "technologies": ("-total_usuarios", "tecnologia"),
    "ai_priority": (f"-{SHARE}", "rotulo_curto"),
    "regions": (f"-{MEAN}", "regiao_onde_mora"),
}
# Bars are drawn from the last position to the first.
BAR_MARTS = ("top_roles", "sectors", "top_profiles", "technologies", "ai_priority", "regions")
LISTED = {"gender_stack": ("genero", GENDER_ORDER), "gender_gap": ("senioridade", SENIORITY_ORDER)}


def drawn(name: str, mart: DataFrame) -> DataFrame:
    """A mart in drawing order with each row's position as a column, since the order of rows is not data."""
    if name in LISTED:
        mart = mart.withColumn("_listed", rank_in(*LISTED[name]))
    ranked = numbered(mart, *POSITIONS[name]).drop("_listed")
    return ranked.orderBy(F.desc(RANK) if name in BAR_MARTS else F.asc(RANK))


# Marts left out, rather than failing, when their Gold result is missing.
OPTIONAL = ("seniority_matrix", "ai_priority")


def build_charts(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every mart whose Gold result is there."""
    missing = sorted(m for m, (source, _) in CHARTS.items() if source not in gold and m not in OPTIONAL)
    if missing:
        raise KeyError(f"no Gold result for {', '.join(missing)}")
    return {mart: drawn(mart, build(gold[source])) for mart, (source, build) in CHARTS.items() if source in gold}
