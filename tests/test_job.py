"""The command-line build, from files to tables."""

from webmart.plans import job
from webmart.sinks import files
from webmart.sources import sample


def test_job(spark, sf_dir, tmp_path, capsys):
    shards, folder = str(tmp_path / "shards"), str(tmp_path / "exports")
    some = sample.events(spark, sf_dir)
    for day in ("20240105", "20240120", "20240121"):
        some.where(some.event_date == day).write.parquet(f"{shards}/events_{day}")
    raw = sample.keyword_exports(spark, sf_dir)
    for source in ("organic", "paid"):
        own = raw.where((raw.domain == "merch.google") & (raw.source == source)).drop("domain", "source")
        files.write_csv(own, f"{folder}/{source}_keywords_merch_google.csv", sep=";")
    files.write_csv(sample.rank_exports(spark, sf_dir), f"{folder}/domain_ranks_all.csv", sep=";")
    options = "--shards --days 20240101 20240130 --current 2024-01-16 2024-01-30 --previous 2024-01-01 2024-01-15"
    places = ["--events", shards, "--exports", folder, "--staging", "j_staging", "--marts", "j_marts", "--reporting", "j_reports"]
    places += ["--calendar", "2024-01-01", "2024-01-10", "--snapshot-date", "2024-02-03", "--domains", "merch_google=merch.google"]
    job.run(spark, [*places, *options.split()])
    text = capsys.readouterr().out
    assert "rpt_landing_page_performance" in text and "sessions_with_purchases" in text
    sessions = spark.table("j_staging.ga4_sessions")
    assert {str(row.session_date) for row in sessions.select("session_date").distinct().collect()} == {
        "2024-01-05",
        "2024-01-20",
        "2024-01-21",
    }
    assert spark.table("j_marts.fact_sessions").count() == sessions.count() > 0
    other = spark.newSession()
    assert other.table("j_reports.rpt_sessions_enriched").count() == sessions.count()
    assert other.table("j_reports.v_channel_summary").count() > 0
    assert spark.table("j_marts.dim_date").count() == 10
    assert spark.table("j_staging.domain_ranks").where("snapshot_date <> DATE '2024-02-03'").isEmpty()
    assert spark.table("j_marts.dim_competitor").where("is_target").count() == 1
    log = spark.table("j_marts.ai_insights").collect()
    assert len(log) == 1 and log[0].insight_text.startswith("Channel Performance Summary (2024-01-16 to 2024-01-30):")


def test_job_reports_what_it_leaves_out(spark, sf_dir, tmp_path, capsys):
    shards, folder = str(tmp_path / "shards"), str(tmp_path / "exports")
    sample.events(spark, sf_dir).where("event_date = '20240105'").write.parquet(f"{shards}/events_20240105")
    sample.write_keyword_exports(sample.keyword_exports(spark, sf_dir), folder, flawed=True)
    places = ["--events", shards, "--shards", "--exports", folder, "--staging", "r_staging", "--marts", "r_marts"]
    job.run(spark, [*places, "--reporting", "r_reports", "--days", "20240101", "20240130", "--current", "2024-01-01", "2024-01-10"])
    text = capsys.readouterr().out
    rows = spark.table("r_staging.semrush_rejected_rows")
    values = spark.table("r_staging.semrush_rejected_values")
    assert rows.count() > 0 and f"'rows_left_out': {rows.count()}" in text
    for column in ("Position", "CPC"):
        assert values.where(values.column == column).count() > 0
        assert f"'{column}': {values.where(values.column == column).count()}" in text
    assert "organic_keywords_merch_google.csv" in text
    assert "export_file" not in spark.table("r_staging.semrush_keywords").columns
