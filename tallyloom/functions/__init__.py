"""Column expressions. All are built-in Spark functions, so they stay in generated JVM code."""

from tallyloom.functions.answers import (
    blank_to_null,
    first_token,
    flag_sum,
    fold_label,
    label_with,
    midpoint,
    quoted,
    shorten,
    text,
    truth_label,
)
from tallyloom.functions.display import count_suffix, reais, thousands
from tallyloom.functions.numbers import mean_of, percent, relative_gap

__all__ = [
    "blank_to_null",
    "count_suffix",
    "first_token",
    "flag_sum",
    "fold_label",
    "label_with",
    "mean_of",
    "midpoint",
    "percent",
    "quoted",
    "reais",
    "relative_gap",
    "shorten",
    "text",
    "thousands",
    "truth_label",
]
