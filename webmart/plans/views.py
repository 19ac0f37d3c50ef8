"""The reports as catalog views over the saved tables.

A view holds no rows: it reads the fact and the dimensions under their own names, so every session sees a rebuilt table at
once, without a rerun of the reports. Views are made in the order in which they read each other. Their rows are those of the
frames in ``webmart.operators.reporting``, column by column.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from webmart.functions import labels
from webmart.settings import MartSettings
from webmart.sinks.tables import VersionedTable, create_view, ensure_schema


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _total(amount: str) -> str:
    """The sum of doubles that does not depend on the order of rows, as ``casts.exact_sum`` has it."""
    size = f"ABS({amount})"
    return (
        f"CASE WHEN COUNT({amount}) > 0 THEN "
        f"COALESCE(CAST(SUM(CASE WHEN {size} < 1e9D THEN TRY_CAST({amount} AS DECIMAL(27,15)) END) AS DOUBLE), 0D) + "
        f"COALESCE(CAST(SUM(CASE WHEN {size} >= 1e9D AND {size} < 1e25D THEN TRY_CAST({amount} AS DECIMAL(32,7)) END) AS DOUBLE), 0D) + "
        f"COALESCE(SUM(CASE WHEN {size} >= 1e25D THEN {amount} END), 0D) END"
    )


def _share(amount: str) -> str:
    return f"TRY_DIVIDE(CAST({amount} AS DOUBLE), CAST(sessions AS DOUBLE))"


_DEVICE_GROUP = f"IF(LOWER(device_category) IN ({_texts(labels.MOBILE_DEVICES)}), 'Mobile', 'Desktop')"
_RANK_BUCKET = (
    f"CASE WHEN organic_position IS NULL OR organic_position < 1 THEN '{labels.NO_RANK}' "
    + " ".join(f"WHEN organic_position <= {bound} THEN '{name}'" for bound, name in labels.RANK_BUCKETS.items())
    + f" ELSE '{labels.BEYOND_RANKS}' END"
)
_SUMS = f"""COUNT(session_id) AS sessions, COUNT_IF(is_engaged) AS engaged_sessions, COUNT_IF(is_converted) AS conversions,
  {_total("revenue")} AS revenue, SUM(session_duration_sec) AS duration_sum, SUM(page_views) AS page_views_sum"""
_VOLUME = "sessions, engaged_sessions, conversions, revenue"
_RATES = f"""{_share("engaged_sessions")} AS engagement_rate, {_share("conversions")} AS conversion_rate,
  {_share("revenue")} AS revenue_per_session"""
_PAGE_VIEWS = f"{_share('page_views_sum')} AS avg_page_views"

_ENRICHED = f"""
SELECT f.session_id, f.user_pseudo_id, f.ga_session_id, f.session_date, d.year, d.month, d.month_name, d.week_of_year, d.day_name,
  d.is_weekend, f.channel, f.source, f.channel_group, f.device_category, {_DEVICE_GROUP} AS device_group, f.country, f.page_path,
  f.page_category, f.landing_page_path, f.has_seo_data, f.organic_position, p.top_keyword, p.search_volume,
  {_RANK_BUCKET.replace("organic_position", "f.organic_position")} AS seo_rank_bucket, f.session_duration_sec, f.page_views,
  f.purchases, f.revenue, f.engaged_session AS is_engaged, f.purchases > 0 AS is_converted
FROM {{marts}}.fact_sessions f
LEFT JOIN {{marts}}.dim_date d ON f.session_date = d.date_id
LEFT JOIN {{marts}}.dim_page p ON f.page_path = p.page_path"""

_CHANNELS = f"""
SELECT session_date, channel_group, device_group, {_VOLUME}, {_RATES},
  {_share("duration_sum")} AS avg_session_duration_sec, {_PAGE_VIEWS}
FROM (SELECT session_date, channel_group, device_group, {_SUMS} FROM {{reporting}}.rpt_sessions_enriched GROUP BY ALL)"""

_SEO = f"""
SELECT session_date, seo_rank_bucket, page_category, best_organic_position, avg_search_volume, {_VOLUME}, {_RATES}
FROM (
  SELECT session_date, seo_rank_bucket, page_category, MIN(organic_position) AS best_organic_position,
    TRY_DIVIDE(CAST(SUM(CAST(search_volume AS DECIMAL(19,0))) AS DOUBLE), CAST(COUNT(search_volume) AS DOUBLE)) AS avg_search_volume,
    {_SUMS}
  FROM {{reporting}}.rpt_sessions_enriched GROUP BY session_date, seo_rank_bucket, page_category)"""

_LANDING = f"""
SELECT session_date, landing_page_path, page_category, has_seo_data, organic_position, search_volume, top_keyword,
  {_RANK_BUCKET} AS seo_rank_bucket, {_VOLUME}, {_RATES}, {_PAGE_VIEWS}
FROM (SELECT session_date, landing_page_path, {_SUMS} FROM {{reporting}}.rpt_sessions_enriched GROUP BY session_date, landing_page_path) s
LEFT JOIN {{marts}}.dim_page p ON s.landing_page_path = p.page_path"""

_SUMMARY_NAMES = ("sessions", "conversions", "conversion_rate", "revenue", "avg_revenue_per_session")
_SIDES = ", ".join(
    [f"MAX(CASE WHEN period = 'current' THEN {name} END) AS {name}" for name in _SUMMARY_NAMES]
    + [f"COALESCE(MAX(CASE WHEN period = 'previous' THEN {name} END), 0) AS prev_{name}" for name in _SUMMARY_NAMES]
)
_SUMMARY = f"""
SELECT channel_group, {_SIDES}
FROM (
  SELECT channel_group, period, sessions, conversions,
    ROUND(TRY_DIVIDE(CAST(conversions AS DOUBLE), CAST(sessions AS DOUBLE)) * 100, 2) AS conversion_rate,
    ROUND(revenue, 2) AS revenue, ROUND(TRY_DIVIDE(revenue, CAST(sessions AS DOUBLE)), 2) AS avg_revenue_per_session
  FROM (
    SELECT channel_group, period, COUNT(session_id) AS sessions, COUNT_IF(purchases > 0) AS conversions,
      {_total("amount")} AS revenue
    FROM (
      SELECT COALESCE(c.channel_group, '{labels.OTHER_CHANNEL}') AS channel_group, f.session_id, f.purchases, f.session_date,
        COALESCE(f.revenue, 0D) AS amount
      FROM {{marts}}.fact_sessions f LEFT JOIN {{marts}}.dim_channel c ON f.channel = c.channel AND f.source = c.source)
    JOIN (VALUES {{periods}}) AS periods(period, first, last) ON session_date BETWEEN first AND last
    GROUP BY channel_group, period))
GROUP BY channel_group
HAVING BOOL_OR(period = 'current')
ORDER BY revenue DESC, channel_group"""

#: Each view after those that it reads.
REPORT_VIEWS = {
    "rpt_sessions_enriched": _ENRICHED,
    "rpt_channel_performance": _CHANNELS,
    "rpt_seo_performance": _SEO,
    "rpt_landing_page_performance": _LANDING,
    "v_channel_summary": _SUMMARY,
}


def create_report_views(spark: SparkSession, settings: MartSettings, marts: str = "marts", reporting: str = "reporting") -> None:
    """Create or replace all report views; a report that was saved as a table under the name gives way to its view."""
    ensure_schema(spark, reporting)
    periods = {"current": settings.current_period, "previous": settings.previous_period}
    rows = ", ".join(f"('{name}', DATE '{first}', DATE '{last}')" for name, (first, last) in periods.items())
    for name, text in REPORT_VIEWS.items():
        place = f"`{reporting}`.`{name}`"
        saved = VersionedTable(spark, place)
        if saved.versions():
            saved.drop()
        create_view(spark, place, text.format(marts=f"`{marts}`", reporting=f"`{reporting}`", periods=rows))
