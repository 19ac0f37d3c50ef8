"""Dimensions and the session fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webmart.functions import labels, paths
from webmart.functions.calendar import is_weekend, sunday_week
from webmart.functions.params import event_param
from webmart.settings import MartSettings


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last``, both in the single row of ``bounds``."""
    days = F.explode(F.sequence("first", "last", F.expr("interval 1 day")))
    day = F.col("date_id")
    return bounds.select(days.alias("date_id")).select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).cast("bigint").alias("week_of_year"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Calendar of an inclusive range."""
    return calendar(spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last")))


def dim_date_spanning(frame: DataFrame, day: Column) -> DataFrame:
    """Calendar from the first to the last day found in a frame."""
    return calendar(frame.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def dim_channel(sessions: DataFrame) -> DataFrame:
    """One row per medium and source seen in sessions, with its channel group."""
    pairs = sessions.select("channel", "source").distinct()
    return pairs.withColumn("channel_group", labels.channel_group(F.col("channel")))


def viewed_paths(events: DataFrame, settings: MartSettings) -> DataFrame:
    """Distinct paths of all page views, without the site prefix, of nested or of flat events.

    Reads only event names and page locations.
    """
    views = events.where(F.col("event_name") == "page_view")
    location = F.col("page_location") if "page_location" in events.columns else event_param("page_location", "string_value")
    raw = views.select(paths.event_path(location).alias("raw_page_path"))
    return raw.select(paths.strip_prefix(F.col("raw_page_path"), settings.site_prefix).alias("stripped_path")).distinct()


def page_universe(viewed: DataFrame, path_lookup: DataFrame, sessions: DataFrame) -> DataFrame:
    """Distinct page paths: every viewed path under its keyword page if it has one, and every session's page."""
    resolved = viewed.join(path_lookup, "stripped_path", "left").select(
        F.coalesce("keyword_page_path", "stripped_path").alias("page_path")
    )
    return resolved.unionByName(sessions.select("page_path")).distinct()


def dim_page(pages: DataFrame, best_keyword: DataFrame) -> DataFrame:
    """Every page with its best ranked keyword."""
    best = best_keyword.withColumn("has_seo_data", F.lit(True))
    return pages.join(best, "page_path", "left").select(
        "page_path",
        F.col("join_category").alias("page_category"),
        F.col("keyword").alias("top_keyword"),
        "organic_position",
        "search_volume",
        F.coalesce("has_seo_data", F.lit(False)).alias("has_seo_data"),
    )


def dim_competitor(ranks: DataFrame, settings: MartSettings) -> DataFrame:
    """Domains with their ranks and a flag on the target."""
    return ranks.select(
        "domain",
        "semrush_rank",
        "organic_keywords",
        "organic_traffic",
        "organic_cost",
        "paid_keywords",
        (F.col("domain") == settings.target_domain).alias("is_target"),
    )


def with_date(sessions: DataFrame, dates: DataFrame) -> DataFrame:
    """Sessions with their calendar key; NULL outside the calendar."""
    return sessions.join(dates.select("date_id"), F.col("session_date") == F.col("date_id"), "left")


def with_channel_group(sessions: DataFrame, channels: DataFrame) -> DataFrame:
    """Sessions with the group of their medium and source; unknown pairs are ``other``."""
    group = F.coalesce("channel_group", F.lit(labels.OTHER_CHANNEL))
    return sessions.join(channels, ["channel", "source"], "left").withColumn("channel_group", group)


def with_page(sessions: DataFrame, pages: DataFrame) -> DataFrame:
    """Sessions with the search attributes of their page."""
    attributes = pages.select("page_path", "page_category", "organic_position", "has_seo_data")
    return sessions.join(attributes, "page_path", "left")


def fact_sessions(sessions: DataFrame, dates: DataFrame, channels: DataFrame, pages: DataFrame) -> DataFrame:
    """Sessions with their date, channel and page attributes; a session without a match keeps its row.

    No join is hinted: Spark broadcasts a dimension only when its size allows, and otherwise splits crowded keys
    of the sort-merge join at run time.
    """
    joined = with_page(with_channel_group(with_date(sessions, dates), channels), pages)
    return joined.select(
        "session_id",
        "user_pseudo_id",
        "ga_session_id",
        "session_date",
        "date_id",
        "channel",
        "source",
        "channel_group",
        "device_category",
        "country",
        "page_path",
        "page_category",
        "organic_position",
        "has_seo_data",
        "landing_page_path",
        "engaged_session",
        "session_duration_sec",
        "page_views",
        "purchases",
        "revenue",
    )
