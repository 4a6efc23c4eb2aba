"""Expressions over raw and unified answers, given by column name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.catalog.answers import SALARY_MIDPOINTS, TRUTH_LABELS

# Characters a trimmed answer loses at either end.
WHITESPACE = " \t\n\r\x0b\x0c\u00a0"


def quoted(column: str) -> str:
    """A column name in SQL, whatever dots, quotes or backticks it holds."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal in SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def blank_to_null(answer: str) -> Column:
    """An empty answer is a missing answer."""
    return F.expr(f"nullif(cast({quoted(answer)} as string), '')")


def midpoint(band: str, midpoints: Mapping[str, float] = SALARY_MIDPOINTS) -> Column:
    """Numeric midpoint of a salary band; an unknown band gives NULL."""
    branches = " ".join(f"when {text(label)} then {float(value)!r}D" for label, value in midpoints.items())
    return F.expr(f"case {quoted(band)} {branches} end")


def truth_label(answer: str, spellings: Mapping[str, tuple[str, ...]] = TRUTH_LABELS) -> Column:
    """One label per truth value whatever its spelling; anything else gives NULL."""
    branches = " ".join(
        f"when {quoted(answer)} in ({', '.join(map(text, forms))}) then {text(label)}" for label, forms in spellings.items()
    )
    return F.expr(f"case {branches} end")


def fold_label(answer: str, folds: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """Answer texts that drifted between editions, folded onto one label.

    A text without an entry keeps its own wording unless ``otherwise`` says what to show.
    """
    branches = " ".join(f"when {text(wording)} then {text(label)}" for wording, label in folds.items())
    folded = F.expr(f"case {quoted(answer)} {branches} end")
    return F.coalesce(folded, F.expr(quoted(answer)) if otherwise is None else otherwise)


def flag_sum(flags: Iterable[str]) -> Column:
    """Number of flags set. One missing flag makes the sum NULL, a group of its own."""
    return F.expr(" + ".join(f"cast({quoted(flag)} as int)" for flag in flags))


def first_token(answer: str, separator: str = "/") -> Column:
    """Text before the first separator, trimmed."""
    return F.btrim(F.substring_index(F.col(answer), separator, 1), F.lit(WHITESPACE))


def shorten(answer: str, length: int = 30) -> Column:
    """First characters plus an ellipsis, which is always added."""
    return F.concat(F.substring(answer, 1, length), F.lit("..."))


def label_with(answer: str, detail: str) -> Column:
    """``answer (detail)``; NULL when either is missing."""
    return F.concat(F.col(answer), F.lit(" ("), F.col(detail), F.lit(")"))
