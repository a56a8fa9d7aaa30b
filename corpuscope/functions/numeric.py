"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round halves to even, as array libraries do: scale, nearest integer, unscale."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` in doubles; NULL when the whole is zero."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double") * F.lit(100.0))
