"""Reports over the session fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmart.functions import casts, kpis, labels
from webmart.settings import MartSettings


def sessions_enriched(fact: DataFrame, dates: DataFrame, pages: DataFrame) -> DataFrame:
    """The fact, or sessions with their channel group, with calendar, device group, page and rank bucket.

    One row per session. Each dimension is joined once; page columns that the rows already have are kept.
    """
    on_date = dates.select("date_id", "year", "month", "month_name", "week_of_year", "day_name", "is_weekend")
    on_page = pages.select("page_path", *[name for name in pages.columns if name not in fact.columns])
    dated = fact.drop("date_id").join(on_date, F.col("session_date") == F.col("date_id"), "left")
    return dated.join(on_page, "page_path", "left").select(
        "session_id",
        "user_pseudo_id",
        "ga_session_id",
        "session_date",
        "year",
        "month",
        "month_name",
        "week_of_year",
        "day_name",
        "is_weekend",
        "channel",
        "source",
        "channel_group",
        "device_category",
        labels.device_group(F.col("device_category")).alias("device_group"),
        "country",
        "page_path",
        "page_category",
        "landing_page_path",
        "has_seo_data",
        "organic_position",
        "top_keyword",
        "search_volume",
        labels.rank_bucket(F.col("organic_position")).alias("seo_rank_bucket"),
        "session_duration_sec",
        "page_views",
        "purchases",
        "revenue",
        F.col("engaged_session").alias("is_engaged"),
        (F.col("purchases") > 0).alias("is_converted"),
    )


def channel_performance(fact: DataFrame) -> DataFrame:
    """KPIs by day, channel group and device group."""
    keys = ("session_date", "channel_group", "device_group")
    sliced = fact.withColumn("device_group", labels.device_group(F.col("device_category")))
    sums = sliced.groupBy(*keys).agg(*kpis.session_sums())
    return sums.select(*keys, *kpis.volume(), *kpis.rates(), kpis.avg_duration(), kpis.avg_page_views())


def seo_performance(fact: DataFrame, pages: DataFrame) -> DataFrame:
    """KPIs by day, rank bucket and page category.

    Sessions are summed per day and page before the page dimension is joined, so that the join sees a page once a
    day instead of once a session; the sums are then added up per slice.
    """
    keys = ("session_date", "seo_rank_bucket", "page_category")
    per_page = fact.groupBy("session_date", "page_path", "page_category", "organic_position").agg(
        *kpis.session_sums(), F.count(F.lit(1)).alias("rows")
    )
    volumes = per_page.join(pages.select("page_path", "search_volume"), "page_path", "left")
    weight = F.when(F.col("search_volume").isNotNull(), F.col("rows"))
    weighted = F.col("search_volume").cast("decimal(19,0)") * F.col("rows").cast("decimal(19,0)")
    sums = (
        volumes.withColumn("seo_rank_bucket", labels.rank_bucket(F.col("organic_position")))
        .groupBy(*keys)
        .agg(
            F.min("organic_position").alias("best_organic_position"),
            F.try_divide(F.sum(weighted).cast("double"), F.sum(weight).cast("double")).alias("avg_search_volume"),
            *kpis.sums_again(),
        )
    )
    return sums.select(*keys, "best_organic_position", "avg_search_volume", *kpis.volume(), *kpis.rates())


def landing_page_performance(fact: DataFrame, pages: DataFrame) -> DataFrame:
    """KPIs by day and landing page, with the page's search attributes; summed first, joined after."""
    sums = fact.groupBy("session_date", "landing_page_path").agg(*kpis.session_sums())
    joined = sums.join(pages, F.col("landing_page_path") == F.col("page_path"), "left")
    return joined.select(
        "session_date",
        "landing_page_path",
        "page_category",
        "has_seo_data",
        "organic_position",
        "search_volume",
        "top_keyword",
        labels.rank_bucket(F.col("organic_position")).alias("seo_rank_bucket"),
        *kpis.volume(),
        *kpis.rates(),
        kpis.avg_page_views(),
    )


def _within(period: tuple[date, date]) -> Column:
    return F.col("session_date").between(F.lit(period[0]), F.lit(period[1]))


_SUMMARY = ("sessions", "conversions", "conversion_rate", "revenue", "avg_revenue_per_session")


def channel_summary(fact: DataFrame, channels: DataFrame, settings: MartSettings, unique: bool = False) -> DataFrame:
    """Channel groups of the current period beside the same figures of the previous one, most revenue first.

    ``unique`` says that no session has two rows, as in a fact that the mart built: sessions are then counted as rows, and
    no session id is shuffled. Both periods come from one pass: a session counts once for each period it falls in, and the two rows per group
    are then laid side by side. Groups seen in the previous period only are left out.
    """
    periods = {"current": settings.current_period, "previous": settings.previous_period}
    marks = F.filter(
        F.array(*[F.when(_within(days), F.lit(name)) for name, days in periods.items()]), lambda mark: mark.isNotNull()
    )
    grouped = channels.select("channel", "source", F.col("channel_group").alias("_group"))
    counted = (
        fact.select("session_id", "session_date", "channel", "source", "purchases", "revenue")
        .where(_within(settings.current_period) | _within(settings.previous_period))
        .join(grouped, ["channel", "source"], "left")
        .select(
            F.coalesce("_group", F.lit(labels.OTHER_CHANNEL)).alias("channel_group"),
            F.explode(marks).alias("period"),
            "session_id",
            "purchases",
            F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        )
        .groupBy("channel_group", "period")
        .agg(
            (F.count if unique else F.count_distinct)("session_id").alias("sessions"),
            F.count_if(F.col("purchases") > 0).alias("conversions"),
            casts.exact_sum(F.col("revenue")).alias("revenue"),
        )
    )
    sessions = F.col("sessions").cast("double")
    rated = counted.select(
        "channel_group",
        "period",
        "sessions",
        "conversions",
        F.round(F.try_divide(F.col("conversions").cast("double"), sessions) * 100, 2).alias("conversion_rate"),
        F.round("revenue", 2).alias("revenue"),
        F.round(F.try_divide("revenue", sessions), 2).alias("avg_revenue_per_session"),
    )

    def of(period: str, name: str) -> Column:
        return F.max(F.when(F.col("period") == period, F.col(name)))

    sides = rated.groupBy("channel_group").agg(
        F.bool_or(F.col("period") == "current").alias("_seen"),
        *[of("current", name).alias(name) for name in _SUMMARY],
        *[F.coalesce(of("previous", name), F.lit(0)).alias(f"prev_{name}") for name in _SUMMARY],
    )
    return sides.where("_seen").drop("_seen").orderBy(F.col("revenue").desc(), "channel_group")


def channel_brief(summary: DataFrame) -> DataFrame:
    """One block of text per channel group: sessions, conversions, and the change in rate and revenue."""
    rate_change = F.col("conversion_rate") - F.col("prev_conversion_rate")
    revenue_change = F.col("revenue") - F.col("prev_revenue")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Channel: "), "channel_group"),
        F.format_string("  Sessions: %,d", "sessions"),
        F.format_string("  Conversions: %,d", "conversions"),
        F.concat(
            F.lit("  Conversion Rate: "),
            F.col("conversion_rate").cast("string"),
            F.lit("% (Previous: "),
            F.col("prev_conversion_rate").cast("string"),
            F.format_string("%%, Change: %+.2f%%)", rate_change),
        ),
        F.format_string(
            "  Revenue: $%,.2f (Previous: $%,.2f, Change: $%+,.2f)", "revenue", "prev_revenue", revenue_change
        ),
    )
    return summary.select("channel_group", "revenue", text.alias("brief"))


def brief_report(brief: DataFrame, settings: MartSettings) -> DataFrame:
    """The blocks of all channel groups as one text, most revenue first.

    There are as many blocks as channel groups, which are a fixed handful of labels. Without any block it fails.
    """
    first, last = settings.current_period
    title = F.lit(f"Channel Performance Summary ({first.isoformat()} to {last.isoformat()}):\n")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("revenue")).alias("place"), "channel_group", "brief")))
    blocks = F.transform(ordered, lambda row: F.concat(row["brief"], F.lit("\n")))
    text = F.concat_ws("\n", title, F.array_join(blocks, "\n"))
    empty = F.raise_error(F.lit("the channel summary holds no rows"))
    return brief.agg(F.when(F.count(F.lit(1)) == 0, empty).otherwise(text).alias("insight_text"))
