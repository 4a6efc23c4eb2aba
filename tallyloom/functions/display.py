"""Texts shown next to bars and axes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(value: Column) -> Column:
    """Whole number with dots between thousands."""
    return F.translate(F.format_number(value, 0), ",", ".")


def reais(value: Column) -> Column:
    """Whole amount in reais; a missing amount shows as zero."""
    return F.concat(F.lit("R$ "), thousands(F.coalesce(value, F.lit(0.0))))


def count_suffix(value: Column, unit: str) -> Column:
    """``3 lang.``-style label."""
    return F.concat(value.cast("string"), F.lit(f" {unit}"))
