
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

try:  # the training-data operators may be left out
    import corpus_pipeline  # noqa: E402
    from webmart.llm import queries as llm  # noqa: E402
except ImportError:
    corpus_pipeline = llm = None
from oracle.sql import statements  # noqa: E402
from webmart.functions import paths  # noqa: E402
from webmart.functions.categories import event_category  # noqa: E402
from webmart.operators import dimensions, keywords, quality, reporting, sessions  # noqa: E402
from webmart.plans.mart import Mart, build_mart  # noqa: E402
from webmart.sinks import files, insights  # noqa: E402
from webmart.sinks.tables import ScratchStore, VersionedTable, ensure_schema, scratch_folder  # noqa: E402
from webmart.sources import events, exports, sample  # noqa: E402

_SETTINGS = sample.SETTINGS
_EVENT_KEYS = ("user_pseudo_id", "event_timestamp", "page_location")


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded keyword table, saved: lookups then read its paths and categories instead of working them out again."""
    return ScratchStore(spark).save("staging", "semrush_keywords", sample.loaded_keywords(spark, sf_dir))


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.extract_events(sample.events(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.stg_sessions(sample.events(spark, sf_dir), _keywords(spark, sf_dir), _SETTINGS)


def _mart(spark: SparkSession, sf_dir: str) -> Mart:
    return Mart(
        sample.events(spark, sf_dir),
        sample.loaded_keywords(spark, sf_dir),
        sample.domain_ranks(spark, sf_dir),
        _SETTINGS,
    )


def _events_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.events(spark, sf_dir).select(
        "user_pseudo_id",
        "event_date",
        "event_name",
        "event_timestamp",
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.source").alias("source"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
    )


def _event_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _extracted(spark, sf_dir).select(*_EVENT_KEYS)
    return pages.withColumn("page_path", paths.event_path(F.col("page_location")))


def _stripped_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = paths.strip_prefix(F.col("page_path"), _SETTINGS.site_prefix)
    return _event_paths(spark, sf_dir).select(*_EVENT_KEYS, stripped.alias("stripped_path"))


def _event_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stripped_paths(spark, sf_dir).withColumn("category", event_category("stripped_path"))


def _keyword_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.keyword_exports(spark, sf_dir)
    return raw.select("Keyword", "Url", paths.keyword_path(F.col("Url")).alias("page_path"))


def _page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", paths.event_path(url).alias("event_path"), paths.keyword_path(url).alias("keyword_path")
    )


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/keywords.csv"
    files.write_csv(sample.keyword_exports(spark, sf_dir), path, sep=";")
    return exports.read_export(spark, path)


def _keyword_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes one export per domain and source, the two families with different columns, and reads them all back."""
    root = scratch_folder(spark)
    sample.write_keyword_exports(sample.keyword_exports(spark, sf_dir), root)
    return exports.read_keyword_exports(spark, root, _SETTINGS.domains)


def _flawed_exports(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_folder(spark)
    sample.write_keyword_exports(sample.keyword_exports(spark, sf_dir), root, flawed=True)
    return root


def _export_name(path: str) -> Column:
    return F.regexp_extract(path, r"/((?:organic|paid)_keywords_[^/]+)\.csv", 1)


def _keyword_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a load of flawed exports leaves out: rows with a field too many, and values that do not fit their type."""
    root = _flawed_exports(spark, sf_dir)
    read = exports.read_keyword_exports(spark, root, _SETTINGS.domains, with_file=True)
    values = keywords.rejected_values(keywords.prepare_keywords(read, _SETTINGS))
    rows = exports.rejected_rows(spark, root, _SETTINGS.domains)
    return values.select(
        _export_name("export_file").alias("export"), F.col("Keyword").alias("keyword"), "column", "text"
    ).unionByName(
        rows.select(
            _export_name("export_file").alias("export"),
            F.split_part("row_text", F.lit(";"), F.lit(1)).alias("keyword"),
            F.lit(None).cast("string").alias("column"),
            F.col("row_text").alias("text"),
        )
    )


def _export_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each flawed export meets the contract of its family; the line counts of its parts are added up."""
    found = exports.export_check(spark, f"{_flawed_exports(spark, sf_dir)}/*_keywords_*.csv")
    listed = [F.array_join(name, ",").alias(name) for name in ("missing", "extra", "moved")]
    parts = found.where("first_line IS NOT NULL").select(_export_name("path").alias("export"), "accepted", "family", *listed, "lines")
    keys = ["export", "accepted", "family", "missing", "extra", "moved"]
    return parts.groupBy(*keys).agg(F.sum(F.col("lines") - 1).alias("row_count"))


def _domain_ranks_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank exports written as three files, one of them refused, and read back."""
    root = scratch_folder(spark)
    ranks = sample.rank_exports(spark, sf_dir)
    number = F.col("Rank").cast("int")
    for part in (0, 1):
        files.write_csv(ranks.where(number % 2 == part), f"{root}/domain_ranks_{part}.csv", sep=";")
    spark.range(1).select(F.lit("ERROR 120 :: WRONG KEY")).write.text(f"{root}/domain_ranks_2.csv")
    return keywords.load_domain_ranks(exports.read_rank_exports(spark, root), _SETTINGS)


def _table_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be read under a table's name after a first build, a failed one, and one that succeeds."""
    loaded = sample.loaded_keywords(spark, sf_dir)
    table = VersionedTable(spark, f"rebuilt_{uuid.uuid4().hex[:12]}")
    store = ScratchStore(spark)
    failing = loaded.withColumn(
        "Keyword", F.when(F.col("source") == "paid", F.raise_error(F.lit("rejected"))).otherwise(F.col("Keyword"))
    )
    steps = {"first": loaded.where("source = 'organic'"), "failed": failing, "whole": loaded}
    seen = []
    try:
        for step, rows in steps.items():
            try:
                table.replace(rows, ("domain",))
            except Exception as error:
                if step != "failed" or "rejected" not in str(error):
                    raise
            counted = spark.table(table.name).groupBy("domain", "source").agg(
                F.count(F.lit(1)).alias("row_count"), F.sum("Search_Volume").alias("search_volume")
            )
            seen.append(store.save("rebuild", step, counted.withColumn("step", F.lit(step))))
    finally:
        table.drop()
    return reduce(DataFrame.unionByName, seen)


def _page_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _keywords(spark, sf_dir)
    return sessions.resolve_pages(
        sessions.first_page_view(_extracted(spark, sf_dir), _SETTINGS),
        keywords.path_lookup(loaded, _SETTINGS),
        keywords.category_lookup(loaded, _SETTINGS),
    )




def _day_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of some days written as day shards, one day left out, and a sub-range of them read back."""
    root = scratch_folder(spark)
    every = sample.events(spark, sf_dir)
    for day in ("20240103", "20240104", "20240106", "20240107"):
        every.where(F.col("event_date") == day).write.parquet(f"{root}/events_{day}")
    read = events.read_event_shards(spark, root, "20240104", "20240106")
    return read.select("user_pseudo_id", "event_date", "event_name", "event_timestamp", F.size("event_params").alias("n_params"))


def _missing_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keywords of a folder that lacks all exports but the organic ones of two domains."""
    root = scratch_folder(spark)
    raw = sample.keyword_exports(spark, sf_dir).where("source = 'organic' AND domain IN ('merch.google', 'zazzle.com')")
    for key in ("merch_google", "zazzle_com"):
        own = raw.where(F.col("domain") == _SETTINGS.domains[key]).drop("domain", "source")
        files.write_csv(own, f"{root}/organic_keywords_{key}.csv", sep=";")
    return exports.read_keyword_exports(spark, root, _SETTINGS.domains).select("domain", "source", "Keyword", "Url")


def _kept_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared keywords written to one file per domain, read back as text, and loaded with blank text kept."""
    root = scratch_folder(spark)
    files.write_csv_per_domain(sample.prepared_keywords(spark, sf_dir), root)
    parts = [exports.read_export(spark, f"{root}/domain_key={key}", sep=",") for key in _SETTINGS.domains]
    loaded = keywords.load_keywords(reduce(DataFrame.unionByName, parts), replace(_SETTINGS, keep_empty_text=True))
    return loaded.select("domain", "Keyword", "Position", "CPC", "join_category", "Url", "joinable_to_ga4")


def _insight_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The insight log as a partitioned table in a schema of its own, after two runs."""
    schema = f"insights_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, schema)
    try:
        report = reporting.brief_report(_brief(spark, sf_dir), _SETTINGS)
        report = ScratchStore(spark).save("marts", "brief", report)
        insights.create_insights_table(spark, f"{schema}.ai_insights")
        for day in (1, 2):
            insights.append_insights(report, f"{schema}.ai_insights", at=datetime(2024, 2, day, 6, tzinfo=timezone.utc))
        log = spark.table(f"{schema}.ai_insights").select("insight_type", "insight_text", "generated_date")
        return ScratchStore(spark).save("marts", "ai_insights", log)
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def _summary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period summary as another session reads it from its catalog view, after a whole build."""
    run = uuid.uuid4().hex[:12]
    schemas = [f"{layer}_{run}" for layer in ("staging", "marts", "reports")]
    given = (sample.events(spark, sf_dir), sample.loaded_keywords(spark, sf_dir), sample.domain_ranks(spark, sf_dir))
    try:
        build_mart(*given, _SETTINGS, *schemas, report_views=True)
        view = spark.newSession().table(f"{schemas[2]}.v_channel_summary")
        return spark.createDataFrame(view.collect(), view.schema)  # a row for each channel group, a handful
    finally:
        for schema in schemas:
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def _snapshot_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords loaded without a snapshot date carry the day of the run."""
    settings = replace(_SETTINGS, snapshot_date=None)
    loaded = sample.loaded_keywords(spark, sf_dir, settings)
    return loaded.groupBy("domain").agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(F.col("snapshot_date") == F.current_date()).alias("is_today")
    )


def _repeated_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events hold a parameter twice, where every seventh second's events repeat their first one."""
    first = F.slice("event_params", 1, 1)
    second = F.floor(F.col("event_timestamp") / 1_000_000)
    repeated = F.when(second % 7 == 0, F.concat("event_params", first)).otherwise(F.col("event_params"))
    return quality.repeated_params(sample.events(spark, sf_dir).withColumn("event_params", repeated))


def _saved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page dimension of a build that scans the nested events once."""
    mart = Mart(
        sample.events(spark, sf_dir),
        sample.loaded_keywords(spark, sf_dir),
        sample.domain_ranks(spark, sf_dir),
        replace(_SETTINGS, save_events=True),
    )
    return mart.pages_with_keywords


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.read.parquet(f"{sf_dir}/events.parquet")
    return dimensions.dim_date_spanning(days, F.to_date("ts"))


def _brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.channel_brief(_mart(spark, sf_dir).channel_summary())


def _insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/insights"
    report = reporting.brief_report(_brief(spark, sf_dir), _SETTINGS)
    insights.append_insight_files(report, path, at=datetime(2024, 2, 1, 6, tzinfo=timezone.utc))
    log = spark.read.parquet(path)
    stamp = F.date_format(insights.utc(F.col("generated_at")), "yyyy-MM-dd HH:mm:ss").alias("generated_at")
    return log.select(stamp, "insight_type", "insight_text", "generated_date")


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _mart(spark, sf_dir).report(name)


def _over_loaded(operator: Callable, *more: object) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(_keywords(spark, sf_dir), *more)


def _over_prepared(operator: Callable, *more: object) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(sample.prepared_keywords(spark, sf_dir), *more)


def entry(spark: SparkSession) -> DataFrame:
    """Channel performance on the smallest sample."""
    return queries()["rpt_channel_performance"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return mart_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def mart_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ga4_events_scan": _events_scan,
        "ga4_params": _extracted,
        "path_normalize": _event_paths,
        "path_normalize_kw": _keyword_paths,
        "path_normalize_pages": _page_urls,
        "prefix_strip": _stripped_paths,
        "category_ga4": _event_categories,
        "category_kw": _over_prepared(lambda rows: rows.select("Keyword", "page_path", "join_category")),
        "keyword_csv_scan": _csv_scan,
        "keyword_union": _keyword_union,
        "keyword_rejects": _keyword_rejects,
        "export_error_check": _export_check,
        "domain_ranks_scan": _domain_ranks_scan,
        "table_rebuild": _table_rebuild,
        "ga4_day_shards": _day_shards,
        "ga4_param_repeats": _repeated_params,
        "keyword_union_partial": _missing_exports,
        "keyword_load_kept_text": _kept_text,
        "keyword_snapshot_today": _snapshot_today,
        "top_3000_keywords_per_domain": _over_loaded(keywords.top_keywords_per_domain, 3000),
        "insights_table": _insight_table,
        "v_channel_summary_view": _summary_view,
        "dim_page_one_scan": _saved_events,
        "keyword_prepare": sample.prepared_keywords,
        "keyword_load": sample.loaded_keywords,
        "kw_path_lookup": _over_loaded(keywords.path_lookup, _SETTINGS),
        "kw_category_lookup": _over_loaded(keywords.category_lookup, _SETTINGS),
        "best_keyword": _over_loaded(keywords.best_keyword, _SETTINGS),
        "top_keywords_per_domain": _over_loaded(keywords.top_keywords_per_domain),
        "known_keyword_lookup": _over_loaded(keywords.known_keywords, sample.SAMPLE_PHRASES),
        "session_attrs": lambda spark, sf_dir: sessions.session_attrs(_extracted(spark, sf_dir), _SETTINGS),
        "first_page_view": lambda spark, sf_dir: sessions.first_page_view(_extracted(spark, sf_dir), _SETTINGS),
        "session_metrics": lambda spark, sf_dir: sessions.session_metrics(_extracted(spark, sf_dir)),
        "page_resolve": _page_resolve,
        "stg_sessions": _staged,
        "domain_ranks": sample.domain_ranks,
        "dim_date": _dim_date,
        "dim_channel": lambda spark, sf_dir: dimensions.dim_channel(_staged(spark, sf_dir)),
        "page_universe": lambda spark, sf_dir: _mart(spark, sf_dir).page_universe,
        "dim_page": lambda spark, sf_dir: _mart(spark, sf_dir).pages_with_keywords,
        "dim_competitor": lambda spark, sf_dir: _mart(spark, sf_dir).dim_competitor,
        "fact_sessions": lambda spark, sf_dir: _mart(spark, sf_dir).fact_sessions,
        "rpt_sessions_enriched": _report("rpt_sessions_enriched"),
        "rpt_channel_performance": _report("rpt_channel_performance"),
        "rpt_seo_performance": _report("rpt_seo_performance"),
        "rpt_landing_page_performance": _report("rpt_landing_page_performance"),
        "v_channel_summary": lambda spark, sf_dir: _mart(spark, sf_dir).channel_summary(),
        "channel_brief": _brief,
        "insights_append": _insights,
        "val_keyword_counts": _over_loaded(quality.keyword_counts),
        "val_sessions": lambda spark, sf_dir: quality.session_check(_staged(spark, sf_dir)),
        "val_marts": lambda spark, sf_dir: _mart(spark, sf_dir).mart_counts(),
        "val_reporting": lambda spark, sf_dir: _mart(spark, sf_dir).report_counts(),
        "prep_summary": _over_prepared(quality.preparation_summary),
        "prep_category_breakdown": _over_prepared(quality.category_breakdown, _SETTINGS),
        "prep_domain_joinable": _over_prepared(quality.joinable_share),
    }


def oracle_sql() -> dict[str, str]:
    return statements() | (llm.oracle_sql() if llm else {})
