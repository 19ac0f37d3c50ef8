"""Sessions, whole builds, invariants and plans."""

import re
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from webmart.operators import dimensions, keywords, quality, reporting, sessions
from webmart.plans.mart import REPORTS, Mart, build_mart
from webmart.schemas import EVENTS
from webmart.sinks import insights, tables
from webmart.sources import sample
from webmart.sources.events import read_events

SETTINGS = sample.SETTINGS
KEYWORD_COLUMNS = "domain string, source string, Keyword string, Position long, Search_Volume long, Url string, page_path string, join_category string, Traffic_pct double"


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(left.columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.fixture(scope="module")
def mart(spark, sf_dir):
    return Mart(
        sample.events(spark, sf_dir),
        sample.loaded_keywords(spark, sf_dir),
        sample.domain_ranks(spark, sf_dir),
        SETTINGS,
    )


def event(name, ts, user="u", session=1, location=None, engaged=None, msec=None, medium=None, revenue=None, day="20240102"):
    params = []
    if session is not None:
        params.append(("ga_session_id", (session, None)))
    if location is not None:
        params.append(("page_location", (None, location)))
    if engaged is not None:
        params.append(("session_engaged", (None, engaged)))
    if msec is not None:
        params.append(("engagement_time_msec", (msec, None)))
    return (user, day, name, ts, (medium, None), (None,), None, (revenue,), params)


def build(spark, rows, keyword_rows=()):
    loaded = spark.createDataFrame(list(keyword_rows), KEYWORD_COLUMNS)
    staged = sessions.stg_sessions(spark.createDataFrame(rows, EVENTS), loaded, SETTINGS)
    return {(row.user_pseudo_id, row.ga_session_id): row for row in staged.collect()}


def keyword(path, category=None, volume=None, position=1, word="k", domain="merch.google", source="organic"):
    return (domain, source, word, position, volume, "https://merch.google" + path, path, category, 1.0)


def test_session_row(spark):
    rows = [
        event("session_start", 10, location="https://h/google+redesign/A/?q", msec=2500, medium="cpc", engaged="0"),
        event("session_start", 12, location="https://h/late", msec=1, medium="email"),
        event("page_view", 11, location="https://h/Google+Redesign/first"),
        event("page_view", 13, location="https://h/second", engaged="1"),
        event("purchase", 14, revenue=1.1),
        event("purchase", 15, revenue=2.2),
        event("purchase", 16),
        event("scroll", 17, revenue=9.0, engaged="1"),
    ]
    row = build(spark, rows)[("u", 1)]
    assert (row.session_id, row.session_date, row.channel, row.source) == ("u_1", date(2024, 1, 2), "cpc", "(direct)")
    assert (row.device_category, row.country) == ("unknown", "unknown")
    assert (row.landing_page_path, row.page_path) == ("/google+redesign/a", "/first")
    assert (row.engaged_session, row.session_duration_sec) == (True, 3)
    assert (row.page_views, row.purchases, row.revenue) == (2, 3, 3.3)


def test_sessions_without_start_views_or_id(spark):
    rows = [
        event("page_view", 1, user="a", location="https://h/x"),
        event("session_start", 1, user="b", session=2),
        event("session_start", 1, user="c", session=None, location="https://h/l"),
        event("session_start", 2, user="c", session=None),
        event("page_view", 3, user="c", session=None, location="https://h/x", engaged="1"),
        event("purchase", 4, user="c", session=None, revenue=5.0),
        event("session_start", 1, user="d", session=3),
        event("page_view", 2, user="d", session=3),
        event("page_view", 3, user="d", session=3, location="https://h/x"),
    ]
    got = build(spark, rows)
    assert set(got) == {("b", 2), ("c", None), ("d", 3)}
    bare, nameless = got[("b", 2)], got[("c", None)]
    assert (bare.page_path, bare.engaged_session, bare.page_views, bare.session_duration_sec) == ("/", False, 0, 0)
    assert (nameless.session_id, nameless.landing_page_path, nameless.page_path) == (None, "/l", "/")
    assert (nameless.engaged_session, nameless.page_views, nameless.purchases, nameless.revenue) == (False, 0, 0, 0.0)
    # A first view without a location is the first view all the same.
    assert (got[("d", 3)].page_path, got[("d", 3)].page_views) == ("/", 2)


def test_page_resolution_order(spark):
    table = [
        keyword("/apparel/bags.html", "apparel", 1),
        keyword("/apparel/bags", "apparel", 2),
        keyword("/top-mugs", "lifestyle/drinkware", 9),
        keyword("/a-mugs", "lifestyle/drinkware", 9),
        keyword("/low-mugs", "lifestyle/drinkware", None),
        keyword("/paid-mugs", "lifestyle/drinkware", 99, source="paid"),
        keyword("/other-mugs", "lifestyle/drinkware", 99, domain="zazzle.com"),
    ]
    views = ["apparel/bags", "x/mug", "nothing", "apparel/bags.html"]
    rows = []
    for place, view in enumerate(views):
        rows.append(event("session_start", 1, session=place))
        rows.append(event("page_view", 2, session=place, location=f"https://h/{view}"))
    got = build(spark, rows, table)
    # A viewed path keeps its own ".html", so it only meets keyword paths through its category.
    assert [got[("u", place)].page_path for place in range(4)] == ["/apparel/bags.html", "/a-mugs", "/nothing", "/apparel/bags"]


def test_best_keyword_ties(spark):
    table = spark.createDataFrame(
        [
            keyword("/a", position=2, word="x"),
            keyword("/a", position=1, volume=5, word="z"),
            keyword("/a", position=1, volume=5, word="y"),
            keyword("/a", position=1, volume=None, word="a"),
            keyword("/b", position=1, word="p"),
            keyword("/b", position=None, word="q"),
        ],
        KEYWORD_COLUMNS,
    )
    got = {row.page_path: row.keyword for row in keywords.best_keyword(table, SETTINGS).collect()}
    assert got == {"/a": "y", "/b": "q"}


def test_one_pass_equals_the_three_ranked_parts(spark, sf_dir, mart):
    """The fused build against row_number windows and joins, written out step by step."""
    extracted = sessions.extract_events(mart.events)
    ranked = extracted.withColumn("place", F.row_number().over(Window.partitionBy("event_name", *sessions.KEYS).orderBy("event_timestamp")))
    firsts = ranked.where("place = 1")
    attrs = sessions.session_attrs(firsts, SETTINGS).drop("engaged_session")
    pages = sessions.resolve_pages(
        sessions.first_page_view(firsts, SETTINGS),
        keywords.path_lookup(mart.keywords, SETTINGS),
        keywords.category_lookup(mart.keywords, SETTINGS),
    ).drop("raw_page_path", "stripped_path")
    keys = list(sessions.KEYS)
    joined = attrs.join(pages, keys, "left").join(sessions.session_metrics(extracted), keys, "left")
    plain = joined.select(
        F.concat("user_pseudo_id", F.lit("_"), F.col("ga_session_id").cast("string")).alias("session_id"),
        *keys,
        "session_date",
        "channel",
        "source",
        "device_category",
        "country",
        F.coalesce("page_path", F.lit("/")).alias("page_path"),
        "landing_page_path",
        F.coalesce("engaged_session", F.lit(False)).alias("engaged_session"),
        F.round("session_duration_sec").cast("bigint").alias("session_duration_sec"),
        F.coalesce("page_views", F.lit(0)).alias("page_views"),
        F.coalesce("purchases", F.lit(0)).alias("purchases"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )
    same(mart.sessions, plain)


def test_result_does_not_depend_on_partitioning(spark, mart):
    shuffled = sessions.stg_sessions(mart.events.repartition(7, "event_name"), mart.keywords.repartition(3), SETTINGS)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        same(mart.sessions, shuffled)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_crowded_session_stays_exact(spark):
    """One session holds most of the events; equal times are settled the same way on every partitioning."""
    crowd = spark.range(20000).select(
        F.lit("hot").alias("user_pseudo_id"),
        F.lit("20240103").alias("event_date"),
        F.when(F.col("id") % 4 == 0, "session_start").when(F.col("id") % 4 == 3, "purchase").otherwise("page_view").alias("event_name"),
        (F.col("id") % 1000).alias("event_timestamp"),
        F.struct(F.concat(F.lit("m"), (F.col("id") % 37).cast("string")).alias("medium"), F.lit("s").alias("source")).alias("traffic_source"),
        F.struct(F.lit("desktop").alias("category")).alias("device"),
        F.struct(F.lit("X").alias("country")).alias("geo"),
        F.struct((F.col("id") % 7 / 10).alias("purchase_revenue")).alias("ecommerce"),
        F.array(
            F.struct(F.lit("ga_session_id").alias("key"), F.struct(F.lit(1).cast("bigint").alias("int_value"), F.lit(None).cast("string").alias("string_value")).alias("value")),
            F.struct(
                F.lit("page_location").alias("key"),
                F.struct(F.lit(None).cast("bigint").alias("int_value"), F.concat(F.lit("https://h/p"), (F.col("id") % 11).cast("string")).alias("string_value")).alias("value"),
            ),
        ).alias("event_params"),
    )
    loaded = spark.createDataFrame([], KEYWORD_COLUMNS)
    results = [sessions.stg_sessions(crowd.repartition(parts), loaded, SETTINGS).collect() for parts in (1, 16)]
    assert results[0] == results[1]
    (row,) = results[0]
    assert (row.page_views, row.purchases) == (10000, 5000)
    assert row.revenue == pytest.approx(sum(place % 7 / 10 for place in range(3, 20000, 4)))
    assert row.channel == min(f"m{place % 37}" for place in range(0, 20000, 1000))


def test_keys_are_unique_and_no_page_is_orphaned(mart):
    for table, keys in (
        (mart.sessions.where("session_id IS NOT NULL"), ["session_id"]),
        (mart.sessions, list(sessions.KEYS)),
        (mart.dim_date, ["date_id"]),
        (mart.dim_channel, ["channel", "source"]),
        (mart.dim_page, ["page_path"]),
        (mart.dim_competitor, ["domain"]),
    ):
        assert table.groupBy(*keys).count().where("count > 1").count() == 0
    assert mart.fact_sessions.join(mart.dim_page, "page_path", "left_anti").count() == 0
    assert mart.fact_sessions.count() == mart.report(REPORTS[0]).count() == mart.sessions.count()


def test_reports_keep_every_session(mart):
    wanted = mart.fact_sessions.agg(F.count("session_id").alias("n"), F.sum("purchases").alias("p")).first()
    for name in REPORTS[1:]:
        row = mart.report(name).agg(F.sum("sessions").alias("n"), F.sum("revenue").alias("r")).first()
        assert row.n == wanted.n
    assert wanted.p > 0


def test_reports_equal_plain_aggregates_of_the_enriched_rows(mart):
    """The two-step reports against one aggregation over the row-level view."""
    enriched = mart.report("rpt_sessions_enriched")
    plain = enriched.groupBy("session_date", "seo_rank_bucket", "page_category").agg(
        F.min("organic_position").alias("best_organic_position"),
        F.avg(F.col("search_volume").cast("double")).alias("avg_search_volume"),
        F.count("session_id").alias("sessions"),
        F.count_if("is_engaged").alias("engaged_sessions"),
        F.count_if("is_converted").alias("conversions"),
    )
    same(mart.report("rpt_seo_performance").select(plain.columns), plain)
    pages = mart.dim_page.select(F.col("page_path").alias("landing_page_path"), F.col("top_keyword").alias("word"))
    plain = enriched.join(pages, "landing_page_path", "left").groupBy("session_date", "landing_page_path", F.col("word").alias("top_keyword")).agg(
        F.count("session_id").alias("sessions"), F.count_if("is_converted").alias("conversions")
    )
    same(mart.report("rpt_landing_page_performance").select(plain.columns), plain)


def test_landing_pages_can_meet_the_page_dimension(spark, sf_dir):
    from dataclasses import replace

    settings = replace(SETTINGS, normalize_landing=True)
    staged = sessions.stg_sessions(sample.events(spark, sf_dir), sample.loaded_keywords(spark, sf_dir), settings)
    assert staged.where(F.col("landing_page_path").startswith("/google+redesign/")).count() == 0


def fact_row(session, day, medium="organic", purchases=0, revenue=0.0):
    return (session, day, medium, "s", purchases, revenue)


FACT = "session_id string, session_date date, channel string, source string, purchases long, revenue double"


def test_channel_summary_periods(spark):
    now, before = date(2024, 1, 20), date(2024, 1, 5)
    fact = spark.createDataFrame(
        [
            fact_row("a", now, purchases=1, revenue=10.005),
            fact_row("b", now, revenue=None),
            fact_row("b", now),
            fact_row("c", before, purchases=2, revenue=7.0),
            fact_row(None, now, medium="cpc"),
            fact_row("d", before, medium="email"),
            fact_row("e", now, medium="gone", revenue=1.0),
            fact_row("f", date(2023, 1, 1), medium="sm"),
        ],
        FACT,
    )
    channels = dimensions.dim_channel(fact.where("channel <> 'gone'"))
    rows = [row.asDict() for row in reporting.channel_summary(fact, channels, SETTINGS).collect()]
    assert [row["channel_group"] for row in rows] == ["organic search", "other", "paid search"]
    first, _, last = rows
    assert (first["sessions"], first["conversions"], first["conversion_rate"]) == (2, 1, 50.0)
    assert (first["revenue"], first["prev_sessions"], first["prev_conversion_rate"], first["prev_revenue"]) == (10.01, 1, 100.0, 7.0)
    # Rows without a session id keep their group, but there is nothing to divide by.
    assert (last["sessions"], last["conversion_rate"], last["prev_sessions"]) == (0, None, 0)


def test_a_day_in_both_periods_counts_in_both(spark):
    from dataclasses import replace

    settings = replace(SETTINGS, previous_period=(date(2024, 1, 1), date(2024, 1, 20)))
    fact = spark.createDataFrame([fact_row("a", date(2024, 1, 18)), fact_row("b", date(2024, 1, 2))], FACT)
    row = reporting.channel_summary(fact, dimensions.dim_channel(fact), settings).first()
    assert (row.sessions, row.prev_sessions) == (1, 2)


def summary_frame(spark):
    columns = "channel_group string, sessions long, conversions long, conversion_rate double, revenue double, avg_revenue_per_session double, prev_sessions long, prev_conversions long, prev_conversion_rate double, prev_revenue double, prev_avg_revenue_per_session double"
    rows = [
        ("email", 5, 1, 20.0, 12.5, 2.5, 4, 0, 0.0, 1300.0, 0.0),
        ("direct", 12345, 1200, 9.72, 1234567.8, 100.0, 1, 1, 10.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, columns)


def test_brief_text(spark):
    report = reporting.brief_report(reporting.channel_brief(summary_frame(spark)), SETTINGS).first().insight_text
    assert report == "\n".join(
        [
            "Channel Performance Summary (2024-01-16 to 2024-01-30):",
            "",
            "Channel: direct",
            "  Sessions: 12,345",
            "  Conversions: 1,200",
            "  Conversion Rate: 9.72% (Previous: 10.0%, Change: -0.28%)",
            "  Revenue: $1,234,567.80 (Previous: $0.00, Change: $+1,234,567.80)",
            "",
            "Channel: email",
            "  Sessions: 5",
            "  Conversions: 1",
            "  Conversion Rate: 20.0% (Previous: 0.0%, Change: +20.00%)",
            "  Revenue: $12.50 (Previous: $1,300.00, Change: $-1,287.50)",
            "",
        ]
    )


def test_brief_of_nothing_fails(spark):
    brief = reporting.channel_brief(summary_frame(spark)).limit(0)
    with pytest.raises(PySparkException, match="holds no rows"):
        reporting.brief_report(brief, SETTINGS).collect()


def test_insight_log(spark):
    tables.ensure_schema(spark, "notes")
    for _ in range(2):
        insights.create_insights_table(spark, "notes.log")
    texts = spark.createDataFrame([("hello",)], "insight_text string")
    insights.append_insights(texts, "notes.log", at=datetime(2024, 2, 1, 6))
    insights.append_insights(texts, "notes.log", kind="other")
    with pytest.raises(PySparkException, match="must not be NULL"):
        insights.append_insights(spark.createDataFrame([(None,)], "insight_text string"), "notes.log")
    log = spark.table("notes.log")
    assert log.count() == 2
    row = log.where("generated_date = DATE'2024-02-01'").first()
    assert (row.insight_type, row.insight_text, row.generated_at) == ("channel_recommendation", "hello", row.created_at)


def test_build_is_repeatable(spark, sf_dir, mart):
    for _ in range(2):
        built = build_mart(
            sample.events(spark, sf_dir),
            sample.loaded_keywords(spark, sf_dir),
            sample.domain_ranks(spark, sf_dir),
            SETTINGS,
            "t_staging",
            "t_marts",
        )
    same(spark.table("t_staging.ga4_sessions"), mart.sessions)
    same(spark.table("t_marts.fact_sessions"), mart.fact_sessions)
    for name in REPORTS:
        same(spark.table(name), mart.report(name))
    assert spark.table("v_channel_summary").collect() == mart.channel_summary().collect()
    assert tables.table_size(spark, "t_marts.fact_sessions")[1] == 20
    counts = {row.table_name: row.row_count for row in built.mart_counts().collect()}
    assert counts == {name: spark.table(f"t_marts.{name}").count() for name in counts}
    plan = spark.table("v_channel_summary")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*session_date", plan)
    tables.create_view(spark, "t_marts.days", "SELECT DISTINCT session_date FROM t_marts.fact_sessions")
    assert spark.table("t_marts.days").count() == 30


def test_scratch_folder_is_the_shared_one(spark):
    assert tables.scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_plans(spark, mart, tmp_path, capsys):
    """One scan and one key shuffle per sessionisation, no Python in any plan, filters and columns at the scan."""
    staged = sessions.stg_sessions(mart.events, mart.keywords, SETTINGS)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[event_id", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(user_pseudo_id", plan)) == 1
    assert "GreaterThanOrEqual(ts" in plan and "EqualTo(domain,merch.google)" in plan
    mart.events.write.parquet(str(tmp_path / "events"))
    stored = read_events(spark, str(tmp_path / "events"), *SETTINGS.event_days)
    capsys.readouterr()
    dimensions.viewed_paths(stored, SETTINGS).explain("formatted")
    viewed = capsys.readouterr().out
    columns = re.search(r"ReadSchema: (.*)", viewed).group(1)
    assert columns == (
        "struct<event_date:string,event_name:string,event_params:array<struct<key:string,value:struct<string_value:string>>>>"
    )
    assert "EqualTo(event_name,page_view)" in viewed
    # Parameters are read in generated code: no lambda takes the scan's projection out of it.
    extracted = sessions.extract_events(stored)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in extracted and extracted.startswith("*(1) Project")
    for frame in (staged, mart.fact_sessions, *[mart.report(name) for name in REPORTS], mart.channel_summary()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_checks(spark):
    table = spark.createDataFrame([("d", "organic"), ("d", "organic"), ("a", "paid")], "domain string, source string")
    assert [tuple(row) for row in quality.keyword_counts(table).collect()] == [("a", "paid", 1), ("d", "organic", 2)]
    empty = spark.createDataFrame([], "total int, joinable_to_ga4 boolean, page_path string, join_category string")
    row = quality.preparation_summary(empty).first()
    assert (row.total_rows, row.joinable_pct) == (0, None)


def test_saved_events_give_the_same_tables_from_one_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "nested")
    sample.events(spark, sf_dir).write.parquet(path)
    nested = spark.read.parquet(path)
    given = (nested, sample.loaded_keywords(spark, sf_dir), sample.domain_ranks(spark, sf_dir))
    twice = Mart(*given, sample.SETTINGS)
    once = Mart(*given, replace(sample.SETTINGS, save_events=True))
    for name in ("sessions", "pages_with_keywords"):
        mine, wanted = getattr(once, name), getattr(twice, name)
        assert mine.exceptAll(wanted).count() == wanted.exceptAll(mine).count() == 0
    plans = [once.page_universe, once.flat_events]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "event_params" not in plan and path not in plan
    assert "event_params" in twice.page_universe._jdf.queryExecution().executedPlan().toString()
