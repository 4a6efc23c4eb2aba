"""From raw editions to one typed table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.catalog.editions import EDITION_COLUMN, RAW_COLUMNS, SILVER_COLUMNS
from tallyloom.functions import blank_to_null, midpoint, quoted, truth_label
from tallyloom.operators.headers import clean_name, column_lineage

MIDPOINT_COLUMN = "faixa_salarial_media"
MIDPOINT_SOURCE = "faixa_salarial"
TRUTH_COLUMNS = ("satisfeito_empresa",)

SILVER_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType() if name == MIDPOINT_COLUMN else T.StringType()) for name in SILVER_COLUMNS]
)


def resolve_columns(present: T.StructType | Iterable[str], wanted: Mapping[str, str]) -> dict[str, str]:
    """Which present column feeds each unified one.

    A column that was cleaned says in its metadata which raw name it had. Without that, a raw
    column may be present under its raw or its cleaned name, but under exactly one of them, and the
    cleaned name must not be numbered, since then several raw names share it: anything else means the
    edition drifted and its mapping must be extended.
    """
    schema = present if isinstance(present, T.StructType) else T.StructType([T.StructField(c, T.StringType()) for c in present])
    columns = set(schema.names)
    lineage: dict[str, list[str]] = {}
    for _, raw, name in column_lineage(schema):
        lineage.setdefault(raw, []).append(name)
    traced = {name for names in lineage.values() for name in names}
    found, problems = {}, []
    for unified, raw in wanted.items():
        aliases = dict.fromkeys((raw, clean_name(raw)))
        hits = lineage.get(raw) or [alias for alias in aliases if alias in columns - traced]
        numbered = f"{clean_name(raw)}_1"
        if raw not in lineage and hits == [clean_name(raw)] != [raw] and numbered in columns:
            hits.append(numbered)
        if len(hits) == 1:
            found[unified] = hits[0]
        else:
            problems.append(f"{unified}: {hits or 'no column named ' + repr(raw)}")
    if problems:
        raise ValueError("columns without exactly one source: " + "; ".join(problems))
    return found


def map_edition(raw: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The raw columns of one edition under their unified names, otherwise untouched."""
    sources = resolve_columns(raw.schema, columns)
    return raw.selectExpr(*(f"{quoted(source)} as {unified}" for unified, source in sources.items()))


def _unified(name: str, edition: str) -> Column:
    if name == EDITION_COLUMN:
        return F.lit(edition)
    if name == MIDPOINT_COLUMN:
        return midpoint(MIDPOINT_SOURCE)
    if name in TRUTH_COLUMNS:
        return truth_label(name)
    return blank_to_null(name)


def conform_edition(raw: DataFrame, edition: str) -> DataFrame:
    """One edition in the unified schema, tagged with its label."""
    mapped = map_edition(raw, RAW_COLUMNS[edition])
    return mapped.select(*(_unified(name, edition).alias(name) for name in SILVER_COLUMNS))


def union_editions(editions: Mapping[str, DataFrame]) -> DataFrame:
    """All editions in one frame; by name, so a branch with other columns fails."""
    return reduce(DataFrame.unionByName, editions.values())


def unify(raw_editions: Mapping[str, DataFrame]) -> DataFrame:
    """Raw editions by label -> the unified survey table."""
    return union_editions({edition: conform_edition(raw, edition) for edition, raw in raw_editions.items()})
