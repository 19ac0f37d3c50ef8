"""Measures shared by the session reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webmart.functions.casts import added, amount_sums

_REVENUE = ("revenue_fine", "revenue_coarse", "revenue_rest")
# Sums that can be added up again, so that a report may aggregate twice.
SUMS = ("sessions", "engaged_sessions", "conversions", *_REVENUE, "duration_sum", "page_views_sum")


def session_sums() -> list[Column]:
    """First aggregation, over fact rows."""
    return [
        F.count("session_id").alias("sessions"),
        F.count_if("engaged_session").alias("engaged_sessions"),
        F.count_if(F.col("purchases") > 0).alias("conversions"),
        *[part.alias(name) for name, part in zip(_REVENUE, amount_sums(F.col("revenue")), strict=True)],
        F.sum("session_duration_sec").alias("duration_sum"),
        F.sum("page_views").alias("page_views_sum"),
    ]


def sums_again() -> list[Column]:
    """Second aggregation, over rows that already hold :func:`session_sums`."""
    return [F.sum(name).alias(name) for name in SUMS]


def _revenue() -> Column:
    return added([F.col(name) for name in _REVENUE])


def volume() -> list[Column]:
    return [
        F.col("sessions"),
        F.col("engaged_sessions"),
        F.col("conversions"),
        _revenue().alias("revenue"),
    ]


def _per_session(amount: Column, name: str) -> Column:
    return F.try_divide(amount.cast("double"), F.col("sessions").cast("double")).alias(name)


def rates() -> list[Column]:
    return [
        _per_session(F.col("engaged_sessions"), "engagement_rate"),
        _per_session(F.col("conversions"), "conversion_rate"),
        _per_session(_revenue(), "revenue_per_session"),
    ]


def avg_duration() -> Column:
    return _per_session(F.col("duration_sum"), "avg_session_duration_sec")


def avg_page_views() -> Column:
    return _per_session(F.col("page_views_sum"), "avg_page_views")
