"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(day: Column) -> Column:
    """Week of the year counted from its first Sunday: days before that Sunday are in week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
