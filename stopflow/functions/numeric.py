"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b, and 0 unless b is positive."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def half_even(c: Column, digits: int = 0) -> Column:
    """Round half to even, the rule of the Python-side results."""
    return F.bround(c, digits)
