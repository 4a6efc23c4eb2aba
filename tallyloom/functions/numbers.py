"""Rounded shares, means and gaps. Operands are doubles so every engine rounds the same value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 1, half_even: bool = False) -> Column:
    """Share of ``whole`` in percent, rounded half-up unless ``half_even``."""
    rounded = F.bround if half_even else F.round
    return rounded(F.lit(100.0) * part.cast("double") / whole.cast("double"), digits)


def mean_of(value: Column, digits: int = 2) -> Column:
    """Mean of the known values of a group, rounded half-up."""
    return F.round(F.avg(value), digits)


def relative_gap(base: Column, other: Column) -> Column:
    """How far ``other`` lies below ``base``, in percent of ``base``."""
    return (base - other) / base * F.lit(100.0)
