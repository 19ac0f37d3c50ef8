"""From events to one row per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmart.functions import casts, params, paths
from webmart.functions.categories import CATEGORIES, event_category
from webmart.operators import keywords as kw
from webmart.settings import MartSettings

KEYS = ("user_pseudo_id", "ga_session_id")

_ATTRIBUTES = (
    "event_timestamp",
    "event_date",
    "medium",
    "source",
    "device_category",
    "country",
    "page_location",
    "engagement_time_msec",
)
START, VIEW, PURCHASE = "session_start", "page_view", "purchase"


def _is(name: str) -> Column:
    return F.col("event_name") == name


def _is_engaged() -> Column:
    return F.col("session_engaged") == "1"


def extract_events(events: DataFrame, strict: bool = False) -> DataFrame:
    """Flat event columns: keys, traffic and device fields, and the four named parameters.

    ``strict`` ends the query where an event has one of the parameters more than once.
    """

    def event_param(key: str, field: str) -> Column:
        return params.event_param(key, field, strict)

    return events.select(
        "user_pseudo_id",
        event_param("ga_session_id", "int_value").alias("ga_session_id"),
        "event_date",
        "event_name",
        "event_timestamp",
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.source").alias("source"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        event_param("page_location", "string_value").alias("page_location"),
        event_param("session_engaged", "string_value").alias("session_engaged"),
        event_param("engagement_time_msec", "int_value").alias("engagement_time_msec"),
    )


def _earliest(condition: Column, *fields: str) -> Column:
    """The fields of the earliest event that meets the condition.

    A struct compares field by field, so the least one is the earliest; the fields after the time settle ties
    the same way on every run. The minimum is combined before the shuffle: a crowded session stays one row per task.
    """
    return F.min(F.when(condition, F.struct(*fields)))


def _purchase_revenue() -> Column:
    return casts.exact_sum(F.when(_is(PURCHASE), F.coalesce("purchase_revenue", F.lit(0.0))).otherwise(F.lit(0.0)))


def _attributes(start: Column, settings: MartSettings) -> list[Column]:
    landing = paths.event_path(start["page_location"])
    if settings.normalize_landing:
        landing = paths.strip_prefix(landing, settings.site_prefix)
    return [
        F.to_date(start["event_date"], "yyyyMMdd").alias("session_date"),
        F.coalesce(start["medium"], F.lit("(none)")).alias("channel"),
        F.coalesce(start["source"], F.lit("(direct)")).alias("source"),
        F.coalesce(start["device_category"], F.lit("unknown")).alias("device_category"),
        F.coalesce(start["country"], F.lit("unknown")).alias("country"),
        landing.alias("landing_page_path"),
        (F.coalesce(start["engagement_time_msec"], F.lit(0)) / 1000).alias("session_duration_sec"),
    ]


def session_attrs(extracted: DataFrame, settings: MartSettings) -> DataFrame:
    """Attributes of each session's earliest start event."""
    start = _earliest(_is(START), *_ATTRIBUTES, "session_engaged")
    engaged = F.coalesce(start["session_engaged"], F.lit("0")) == "1"
    starts = extracted.where(_is(START)).groupBy(*KEYS)
    return starts.agg(*_attributes(start, settings), engaged.alias("engaged_session"))


def first_page_view(extracted: DataFrame, settings: MartSettings) -> DataFrame:
    """Path of each session's earliest page view, as seen and without the site prefix."""
    view = _earliest(_is(VIEW), "event_timestamp", "page_location")
    first = extracted.where(_is(VIEW)).groupBy(*KEYS).agg(paths.event_path(view["page_location"]).alias("raw_page_path"))
    return first.withColumn("stripped_path", paths.strip_prefix(F.col("raw_page_path"), settings.site_prefix))


def session_metrics(extracted: DataFrame) -> DataFrame:
    """Page views, purchases, engagement and revenue of each session with an id."""
    return (
        extracted.where(F.col("ga_session_id").isNotNull())
        .groupBy(*KEYS)
        .agg(
            casts.count_where(_is(VIEW)).alias("page_views"),
            casts.count_where(_is(PURCHASE)).alias("purchases"),
            F.bool_or(_is_engaged()).alias("engaged_session"),
            _purchase_revenue().alias("revenue"),
        )
    )


def resolve_pages(stripped: DataFrame, path_lookup: DataFrame, category_lookup: DataFrame) -> DataFrame:
    """Add ``page_path``: the keyword page of the same path, else the top page of its category, else the path itself.

    The category is worked out only where the path alone found nothing. The category side has one row per known
    category at most, which bounds its broadcast; the path side is left to Spark's own size check.
    """
    by_path = path_lookup.withColumnRenamed("keyword_page_path", "_exact")
    by_category = (
        category_lookup.where(F.col("join_category").isin(*CATEGORIES))
        .withColumnRenamed("keyword_page_path", "_fallback")
        .withColumnRenamed("join_category", "_category")
    )
    exact = stripped.join(by_path.withColumnRenamed("stripped_path", "_path"), F.col("stripped_path") == F.col("_path"), "left")
    missed = F.when(F.col("_exact").isNull(), event_category("stripped_path"))
    matched = exact.withColumn("_wanted", missed).join(
        F.broadcast(by_category), F.col("_wanted") == F.col("_category"), "left"
    )
    return matched.withColumn("page_path", F.coalesce("_exact", "_fallback", "stripped_path")).drop(
        "_path", "_exact", "_wanted", "_category", "_fallback"
    )


def useful_events(extracted: DataFrame) -> DataFrame:
    """The events that sessions or pages read anything from."""
    return extracted.where(_is(START) | _is(VIEW) | _is(PURCHASE) | _is_engaged())


def sessions(
    extracted: DataFrame, path_lookup: DataFrame, category_lookup: DataFrame, settings: MartSettings
) -> DataFrame:
    """One row per session that has a start event, from a single pass over the events.

    Start attributes, first page view and metrics come out of one aggregation on the session key. Events without a
    session id form one row per user, with no page and no metrics.
    """
    useful = useful_events(extracted)
    start = _earliest(_is(START), *_ATTRIBUTES)
    view = _earliest(_is(VIEW), "event_timestamp", "page_location")
    first_path = paths.strip_prefix(paths.event_path(view["page_location"]), settings.site_prefix)
    identified = F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull()

    def metric(value: Column, empty: object) -> Column:
        return F.when(identified, F.coalesce(value, F.lit(empty))).otherwise(F.lit(empty))

    # Everything is derived in the aggregate's own output: rows that reach the joins carry finished columns only.
    grouped = useful.groupBy(*KEYS).agg(
        start.isNotNull().alias("started"),
        *_attributes(start, settings),
        F.when(identified & view.isNotNull(), first_path).alias("stripped_path"),
        metric(F.bool_or(_is_engaged()), False).alias("engaged_session"),
        metric(casts.count_where(_is(VIEW)), 0).cast("bigint").alias("page_views"),
        metric(casts.count_where(_is(PURCHASE)), 0).cast("bigint").alias("purchases"),
        metric(_purchase_revenue(), 0.0).alias("revenue"),
    )
    return resolve_pages(grouped.where("started"), path_lookup, category_lookup).select(
        F.concat("user_pseudo_id", F.lit("_"), F.col("ga_session_id").cast("string")).alias("session_id"),
        *KEYS,
        "session_date",
        "channel",
        "source",
        "device_category",
        "country",
        F.coalesce("page_path", F.lit("/")).alias("page_path"),
        "landing_page_path",
        "engaged_session",
        casts.rounded(F.col("session_duration_sec")).alias("session_duration_sec"),
        "page_views",
        "purchases",
        "revenue",
    )


def stg_sessions(events: DataFrame, keywords: DataFrame, settings: MartSettings) -> DataFrame:
    """Sessions straight from nested events and the loaded keyword table."""
    return sessions(
        extract_events(events, settings.strict_params),
        kw.path_lookup(keywords, settings),
        kw.category_lookup(keywords, settings),
        settings,
    )
