"""Column-name cleaning. Works on names only, so it costs one projection whatever the data size."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import quoted

# A tuple-style header such as ('P0', 'id ') and the name of a column left without one.
TUPLE_HEADER = re.compile(r",\s*'([^']*)'\s*\)$")
UNNAMED = "col_sem_nome"


def clean_name(header: str) -> str:
    """Lower-case ASCII words joined by underscores; a tuple-style header keeps its label only."""
    labelled = TUPLE_HEADER.search(header)
    decomposed = unicodedata.normalize("NFKD", labelled[1] if labelled else header)
    ascii_text = "".join(filter(str.isascii, decomposed)).lower()
    return "_".join(re.findall("[a-z0-9]+", ascii_text)) or UNNAMED


def clean_names(headers: Iterable[str]) -> list[str]:
    """Cleaned names made unique: the first keeps its name, later ones get _1, _2, ..."""
    taken: dict[str, int] = {}
    unique = []
    for header in headers:
        wanted = clean_name(header)
        name, suffix = wanted, taken.get(wanted, 0)
        while name in taken:
            suffix += 1
            name = f"{wanted}_{suffix}"
        taken[wanted] = suffix
        taken.setdefault(name, 0)
        unique.append(name)
    return unique


RAW_NAME, POSITION = "raw_name", "position"


def sanitize_columns(df: DataFrame) -> DataFrame:
    """All columns under cleaned, unique names, renamed by position in one projection.

    Each column keeps its raw name and position as metadata, which Parquet files and tables keep too.
    """
    renamed = df.toDF(*clean_names(df.columns))
    return renamed.select(
        *(
            F.col(name).alias(name, metadata={RAW_NAME: raw, POSITION: position})
            for position, (raw, name) in enumerate(zip(df.columns, renamed.columns, strict=True))
        )
    )


def column_lineage(schema: T.StructType) -> list[tuple[int, str, str]]:
    """Position, raw name and present name of every column that was renamed from a raw one."""
    return [
        (field.metadata[POSITION], field.metadata[RAW_NAME], field.name) for field in schema if RAW_NAME in field.metadata
    ]


def long_format(df: DataFrame, ids: list[str]) -> DataFrame:
    """One row per respondent and question: position, raw and present name of the column, and the answer."""
    lineage = [entry for entry in column_lineage(df.schema) if entry[2] not in ids]
    answers = F.array(
        *(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(raw).alias(RAW_NAME),
                F.lit(name).alias("name"),
                F.col(quoted(name)).cast("string").alias("answer"),
            )
            for position, raw, name in lineage
        )
    )
    return df.select(*ids, F.inline(answers))
