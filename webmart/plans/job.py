"""Command-line build: ``spark-submit run_mart.py --events ... --exports ...``.

Reads day-sharded or day-partitioned events and the keyword and rank exports, saves every table of the mart, logs the
channel brief as an insight text and prints the load checks.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import Observation, SparkSession

from webmart.operators import keywords, quality, reporting
from webmart.plans.mart import build_mart
from webmart.settings import MartSettings
from webmart.sinks import insights, tables
from webmart.sources import events, exports


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    defaults = MartSettings()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--events", required=True, help="folder of the event table or of its day shards")
    parser.add_argument("--shards", action="store_true", help="events lie in events_yyyyMMdd folders")
    parser.add_argument("--format", default="parquet", help="file format of the events")
    parser.add_argument("--exports", required=True, help="folder of the keyword and rank exports")
    parser.add_argument("--staging", default="staging", help="schema for staging tables")
    parser.add_argument("--marts", default="marts", help="schema for dimensions, fact and insight log")
    parser.add_argument("--reporting", default="reporting", help="schema for the saved reports")
    parser.add_argument("--target-domain", default=defaults.target_domain)
    parser.add_argument("--site-prefix", default=defaults.site_prefix)
    parser.add_argument("--domains", nargs="+", metavar="key=domain", help="tracked domains by their export file key")
    parser.add_argument("--snapshot-date", type=date.fromisoformat, metavar="yyyy-MM-dd", help="default: today")
    parser.add_argument("--calendar", nargs=2, type=date.fromisoformat, metavar="yyyy-MM-dd", help="default: the days")
    parser.add_argument("--report-views", action="store_true", help="reports as views instead of saved tables")
    parser.add_argument("--strict-params", action="store_true", help="end the build where an event repeats a parameter")
    parser.add_argument("--save-events", action="store_true", help="save the flat events, so that nested ones are read once")
    parser.add_argument("--keep-empty-text", action="store_true")
    parser.add_argument("--normalize-landing", action="store_true")
    parser.add_argument("--days", nargs=2, default=defaults.event_days, metavar="yyyyMMdd")
    for name in ("current", "previous"):
        period = getattr(defaults, f"{name}_period")
        parser.add_argument(f"--{name}", nargs=2, type=date.fromisoformat, default=period, metavar="yyyy-MM-dd")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    given = _arguments(argv)
    first, last = given.days
    days = [datetime.strptime(day, "%Y%m%d").date() for day in (first, last)]
    tracked = {"domains": dict(pair.split("=", 1) for pair in given.domains)} if given.domains else {}
    settings = MartSettings(
        target_domain=given.target_domain,
        site_prefix=given.site_prefix,
        snapshot_date=given.snapshot_date,
        keep_empty_text=given.keep_empty_text,
        normalize_landing=given.normalize_landing,
        strict_params=given.strict_params,
        save_events=given.save_events,
        event_days=(first, last),
        calendar=tuple(given.calendar or days),
        current_period=tuple(given.current),
        previous_period=tuple(given.previous),
        **tracked,
    )
    read = events.read_event_shards if given.shards else events.read_events
    left_out, losses = Observation("keyword rows"), Observation("keyword values")
    exported = exports.read_keyword_exports(spark, given.exports, settings.domains, counts=left_out, with_file=True)
    prepared = keywords.prepare_keywords(exported, settings)
    ranks = exports.read_rank_exports(spark, given.exports)
    mart = build_mart(
        read(spark, given.events, first, last, given.format),
        keywords.load_keywords(prepared, settings, losses).drop(exports.EXPORT_FILE),
        None if ranks is None else keywords.load_domain_ranks(ranks, settings),
        settings,
        given.staging,
        given.marts,
        given.reporting,
        given.report_views,
    )
    log = f"`{given.marts}`.`ai_insights`"
    insights.create_insights_table(spark, log)
    brief = reporting.channel_brief(mart.channel_summary())
    insights.append_insights(reporting.brief_report(brief, settings), log)

    # both counts were taken while the keyword table was written; what they count is kept only if there is any
    print(f"keyword rows read and left out: {left_out.get}")
    print(f"keyword values that do not fit their type: {losses.get}")
    if left_out.get["rows_left_out"]:
        rejected = exports.rejected_rows(spark, given.exports, settings.domains)
        tables.write_table(rejected, f"`{given.staging}`.`semrush_rejected_rows`")
        quality.rejects_per_file(spark.table(f"`{given.staging}`.`semrush_rejected_rows`")).show(truncate=False)
    if any(count for name, count in losses.get.items() if name != "rows"):
        tables.write_table(keywords.rejected_values(prepared), f"`{given.staging}`.`semrush_rejected_values`")
    quality.preparation_summary(mart.keywords).show()
    quality.category_breakdown(mart.keywords, settings).show(truncate=False)
    quality.joinable_share(mart.keywords).show()
    quality.keyword_counts(mart.keywords).show()
    quality.session_check(mart.sessions).show()
    mart.mart_counts().show()
    mart.report_counts().show(truncate=False)
