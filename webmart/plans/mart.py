"""The whole mart: staging tables, dimensions, fact and reports."""

from __future__ import annotations

from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from webmart.operators import dimensions, keywords, quality, reporting, sessions
from webmart.plans.views import create_report_views
from webmart.settings import MartSettings
from webmart.sinks.tables import CatalogStore, ScratchStore

REPORTS = (
    "rpt_sessions_enriched",
    "rpt_channel_performance",
    "rpt_seo_performance",
    "rpt_landing_page_performance",
)


class Store(Protocol):
    def save(self, layer: str, name: str, frame: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame: ...


class Mart:
    """Tables of the mart over event, keyword and rank frames; each table is built when first asked for.

    Tables that several others read (keywords, sessions, channels, pages) are saved before use. That runs the event
    scan once, keeps path and category rules out of later plans, and lets Spark decide on each dimension join by the
    size of a finished table. Reports stay lazy frames.
    """

    def __init__(
        self,
        events: DataFrame,
        loaded_keywords: DataFrame,
        ranks: DataFrame | None,
        settings: MartSettings,
        store: Store | None = None,
    ):
        self.spark: SparkSession = events.sparkSession
        self.events = events
        self.loaded_keywords = loaded_keywords
        self.ranks = ranks
        self.settings = settings
        self.store = store or ScratchStore(self.spark)

    @cached_property
    def keywords(self) -> DataFrame:
        return self.store.save("staging", "semrush_keywords", self.loaded_keywords)

    @cached_property
    def flat_events(self) -> DataFrame:
        """The events that the mart reads, flat; saved if the settings say so, which scans the nested ones once."""
        flat = sessions.extract_events(self.events, self.settings.strict_params)
        return self.store.save("staging", "ga4_events", sessions.useful_events(flat)) if self.settings.save_events else flat

    @cached_property
    def sessions(self) -> DataFrame:
        lookups = (lookup(self.keywords, self.settings) for lookup in (keywords.path_lookup, keywords.category_lookup))
        staged = sessions.sessions(self.flat_events, *lookups, self.settings)
        return self.store.save("staging", "ga4_sessions", staged, ("session_date",))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, *self.settings.calendar)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self.store.save("marts", "dim_channel", dimensions.dim_channel(self.sessions))

    @cached_property
    def page_universe(self) -> DataFrame:
        return dimensions.page_universe(
            dimensions.viewed_paths(self.flat_events if self.settings.save_events else self.events, self.settings),
            keywords.path_lookup(self.keywords, self.settings),
            self.sessions,
        )

    @cached_property
    def pages_with_keywords(self) -> DataFrame:
        return dimensions.dim_page(self.page_universe, keywords.best_keyword(self.keywords, self.settings))

    @cached_property
    def dim_page(self) -> DataFrame:
        return self.store.save("marts", "dim_page", self.pages_with_keywords)

    @cached_property
    def dim_competitor(self) -> DataFrame | None:
        return None if self.ranks is None else dimensions.dim_competitor(self.ranks, self.settings)

    @cached_property
    def fact_sessions(self) -> DataFrame:
        return dimensions.fact_sessions(self.sessions, self.dim_date, self.dim_channel, self.dim_page)

    @cached_property
    def saved_fact(self) -> DataFrame:
        return self.store.save("marts", "fact_sessions", self.fact_sessions, ("session_date",))

    def report(self, name: str, fact: DataFrame | None = None) -> DataFrame:
        """One of :data:`REPORTS`, over the given fact.

        Without one, a report joins the saved sessions with those dimensions only that it reads, so that none waits
        for a dimension it has no use for.
        """
        if name == "rpt_sessions_enriched":
            fact = dimensions.with_channel_group(self.sessions, self.dim_channel) if fact is None else fact
            return reporting.sessions_enriched(fact, self.dim_date, self.dim_page)
        if name == "rpt_channel_performance":
            fact = dimensions.with_channel_group(self.sessions, self.dim_channel) if fact is None else fact
            return reporting.channel_performance(fact)
        if name == "rpt_seo_performance":
            fact = dimensions.with_page(self.sessions, self.dim_page) if fact is None else fact
            return reporting.seo_performance(fact, self.dim_page)
        if name == "rpt_landing_page_performance":
            return reporting.landing_page_performance(self.sessions if fact is None else fact, self.dim_page)
        raise KeyError(name)

    def channel_summary(self, fact: DataFrame | None = None) -> DataFrame:
        """Period comparison over the mart's fact or, as it needs session columns only, over the saved sessions.

        Both hold a session once: sessions are groups of user and session number, whose id tells them apart, and every
        dimension has its key once.
        """
        return reporting.channel_summary(self.sessions if fact is None else fact, self.dim_channel, self.settings, unique=True)

    def mart_counts(self) -> DataFrame:
        """Rows of each dimension and of the fact."""
        tables = {
            "dim_date": self.dim_date,
            "dim_channel": self.dim_channel,
            "dim_page": self.dim_page,
            "dim_competitor": self.dim_competitor,
            "fact_sessions": self.fact_sessions,
        }
        return quality.row_counts({name: table for name, table in tables.items() if table is not None})

    def report_counts(self) -> DataFrame:
        """Rows of each report."""
        return quality.row_counts({name: self.report(name, self.saved_fact) for name in REPORTS}, "view_name")


def build_mart(
    events: DataFrame,
    loaded_keywords: DataFrame,
    ranks: DataFrame | None,
    settings: MartSettings,
    staging: str = "staging",
    marts: str = "marts",
    reporting_schema: str = "reporting",
    report_views: bool = False,
) -> Mart:
    """Build and save every table of the mart in catalog schemas; running it again replaces them.

    Reports ``rpt_*`` and ``v_channel_summary`` are saved too, in a schema of their own, so that other sessions can
    read them; with ``report_views`` they are catalog views instead, which are computed when they are read. The
    building session also has them as temporary views under their bare names.
    """
    spark = events.sparkSession
    store = CatalogStore(spark, staging, marts, reporting_schema)
    kept_ranks = None if ranks is None else store.save("staging", "domain_ranks", ranks)
    mart = Mart(events, loaded_keywords, kept_ranks, settings, store)
    mart.dim_date = store.save("marts", "dim_date", dimensions.dim_date(spark, *settings.calendar))
    if kept_ranks is not None:
        mart.dim_competitor = store.save(
            "marts", "dim_competitor", dimensions.dim_competitor(kept_ranks, settings)
        )
    mart.fact_sessions = mart.saved_fact
    for name in REPORTS:
        report = mart.report(name, mart.saved_fact)
        report.createOrReplaceTempView(name)
        if not report_views:
            store.save("reporting", name, report)
    summary = mart.channel_summary(mart.saved_fact)
    summary.createOrReplaceTempView("v_channel_summary")
    if report_views:
        create_report_views(spark, settings, marts, reporting_schema)
    else:
        store.save("reporting", "v_channel_summary", summary)
    return mart
