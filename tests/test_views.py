"""Reports as catalog views: the rows of the frames, in any session, over whatever the tables hold."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from webmart.plans.mart import REPORTS, build_mart
from webmart.plans.views import REPORT_VIEWS
from webmart.sinks import tables
from webmart.sources import sample


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    given = (sample.events(spark, sf_dir), sample.loaded_keywords(spark, sf_dir), sample.domain_ranks(spark, sf_dir))
    return build_mart(*given, sample.SETTINGS, "w_staging", "w_marts", "w_reports", report_views=True)


def test_views_have_the_rows_of_the_frames(spark, built):
    assert list(REPORT_VIEWS) == [*REPORTS, "v_channel_summary"]
    other = spark.newSession()
    for name in REPORTS:
        wanted, found = built.report(name, built.saved_fact), other.table(f"w_reports.{name}")
        assert found.columns == wanted.columns and dict(found.dtypes) == dict(wanted.dtypes)
        mine = sorted(map(repr, found.collect()))
        assert mine == sorted(map(repr, wanted.collect())) and mine
    summary = [tuple(row) for row in other.table("w_reports.v_channel_summary").collect()]
    assert summary == [tuple(row) for row in built.channel_summary(built.saved_fact).collect()]  # sorted alike, too


def test_views_see_a_rebuilt_fact_without_a_rerun(spark, built):
    other = spark.newSession()
    before = other.table("w_reports.v_channel_summary").agg(F.sum("sessions")).first()[0]
    fact = spark.table("w_marts.fact_sessions")
    some = fact.where("pmod(xxhash64(session_id), 2) = 0")
    wanted = built.channel_summary(some).collect()
    some_ids = some.where("session_id IS NOT NULL").count()
    tables.write_table(some, "`w_marts`.`fact_sessions`", ("session_date",))
    assert [tuple(row) for row in other.table("w_reports.v_channel_summary").collect()] == [tuple(row) for row in wanted]
    assert other.table("w_reports.v_channel_summary").agg(F.sum("sessions")).first()[0] < before
    assert other.table("w_reports.rpt_channel_performance").agg(F.sum("sessions")).first()[0] == some_ids


def test_saved_reports_and_views_may_take_each_others_place(spark, sf_dir, built):
    given = (sample.events(spark, sf_dir), sample.loaded_keywords(spark, sf_dir), None)
    settings = replace(sample.SETTINGS, event_days=("20240101", "20240110"))
    build_mart(*given, settings, "w_staging", "w_marts", "w_mixed")
    build_mart(*given, settings, "w_staging", "w_marts", "w_mixed", report_views=True)
    assert spark.table("w_mixed.v_channel_summary").count() > 0
    assert tables.VersionedTable(spark, "w_mixed.v_channel_summary").versions() == []
