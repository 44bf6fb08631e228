"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopflow.config import WEEKDAYS_EN, WEEKDAYS_FR


def weekday(day: Column) -> Column:
    """0 is Monday."""
    return F.weekday(day)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def weekday_name(day: Column, names: list[str] = WEEKDAYS_EN) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in names]), F.weekday(day) + 1)


def weekday_name_fr(day: Column) -> Column:
    return weekday_name(day, WEEKDAYS_FR)


def date_parts(day: Column) -> dict[str, Column]:
    """The five calendar features that depend on the date alone."""
    return {
        "weekday": weekday(day),
        "is_weekend": is_weekend(day),
        "month": F.month(day),
        "iso_week": F.weekofyear(day),
        "year": F.year(day),
    }
