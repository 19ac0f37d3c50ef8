"""Checks made after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmart.functions.params import PARAMS, param_count

from webmart.settings import MartSettings

# Fixed value: label of keyword rows without a category.
NO_CATEGORY = "None (not joinable)"


def keyword_counts(keywords: DataFrame) -> DataFrame:
    """Rows by domain and source."""
    counts = keywords.groupBy("domain", "source").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy("domain", "source")


def session_check(sessions: DataFrame) -> DataFrame:
    """Rows, date range and sessions with a purchase."""
    return sessions.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("session_date").alias("earliest_date"),
        F.max("session_date").alias("latest_date"),
        F.count_if(F.col("purchases") > 0).alias("sessions_with_purchases"),
    )


def row_counts(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Rows of each table, under its name."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def preparation_summary(prepared: DataFrame) -> DataFrame:
    """Prepared keyword rows: joinable, product pages and the rest, each with its share in percent."""
    sums = prepared.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("joinable_to_ga4").alias("joinable"),
        F.count_if(F.col("page_path").startswith("/product/")).alias("product_pages"),
        F.count_if(F.col("join_category").isNull()).alias("_uncategorised"),
    ).withColumn("other_non_joinable", F.col("_uncategorised") - F.col("product_pages"))

    def share(name: str) -> Column:
        return (F.try_divide(F.col(name).cast("double"), F.col("total_rows").cast("double")) * 100).alias(f"{name}_pct")

    parts = ("joinable", "product_pages", "other_non_joinable")
    return sums.select("total_rows", *parts, *[share(name) for name in parts])


def category_breakdown(prepared: DataFrame, settings: MartSettings) -> DataFrame:
    """Rows of the target domain by category, most first."""
    target = prepared.where(F.col("domain") == settings.target_domain)
    category = F.coalesce("join_category", F.lit(NO_CATEGORY)).alias("category")
    counts = target.groupBy(category).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.col("row_count").desc(), "category")


def joinable_share(prepared: DataFrame) -> DataFrame:
    """Rows of each domain and the share that can meet an event page."""
    joinable = F.col("joinable_to_ga4").cast("int")
    return prepared.groupBy("domain").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(F.coalesce(joinable, F.lit(0))).alias("joinable_share"),
    )


def rejects_per_file(rejected: DataFrame) -> DataFrame:
    """Rows left out of each export file."""
    return rejected.groupBy("export_file").agg(F.count(F.lit(1)).alias("row_count")).orderBy("export_file")


def repeated_params(events: DataFrame) -> DataFrame:
    """For each parameter that the mart reads, the events that have it and those that have it more than once."""
    counts = [
        F.struct(
            F.lit(key).alias("param"),
            F.count_if(param_count(key) > 0).alias("event_count"),
            F.count_if(param_count(key) > 1).alias("repeated_count"),
        )
        for key in PARAMS
    ]
    return events.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
