"""Readers, keyword load and file sinks."""

import os

import pytest
from pyspark.sql import functions as F

from webmart import schemas
from webmart.operators import keywords
from webmart.settings import DOMAINS, MartSettings
from webmart.sinks import files, tables
from webmart.sources import events, exports, sample


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)
    return path


def test_export_rows(spark, tmp_path):
    body = 'a;b;c\n1;2;3\n4;5\n;x;\nnull;NA;nan\n6;7;8;9\n6;7;8;\n"q;q";"say ""hi""";z\n'
    frame = exports.read_export(spark, put(tmp_path, "x.csv", body))
    assert frame.columns == ["a", "b", "c"]
    assert [tuple(row) for row in frame.collect()] == [
        ("1", "2", "3"),
        ("4", "5", None),
        (None, "x", None),
        ("null", "NA", "nan"),
        ("q;q", 'say "hi"', "z"),
    ]
    assert frame.select("b").count() == 5
    assert [row.b for row in frame.select("b").collect()] == ["2", "5", "x", "NA", 'say "hi"']


def test_export_with_line_breaks_in_fields(spark, tmp_path):
    path = put(tmp_path, "x.csv", 'a;b\n"one\ntwo";3\n')
    assert exports.read_export(spark, path, multiline=True).collect() == [("one\ntwo", "3")]


def test_export_header(spark, tmp_path):
    assert exports.column_names('a;"b;c";a;a') == ["a", "b;c", "a.1", "a.2"]
    path = put(tmp_path, "x.csv", "﻿Keyword;Traffic (%)\nk;1\n")
    assert exports.read_export(spark, path).columns == ["Keyword", "Traffic (%)"]
    assert exports.read_export(spark, put(tmp_path, "empty.csv", "")).columns == []


def test_export_status(spark, tmp_path):
    bad = put(tmp_path, "bad.csv", "ERROR 50 :: NOTHING FOUND")
    good = put(tmp_path, "good.csv", "Keyword;Url\nERROR;x\n")
    status = {row.path: row.accepted for row in exports.export_status(spark, [bad, good]).collect()}
    assert status == {bad: False, good: True}


def test_keyword_exports(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        exports.read_keyword_exports(spark, str(tmp_path))
    put(tmp_path, "organic_keywords_merch_google.csv", "Keyword;Url;Trends\nk1;https://h/a;t\n")
    put(tmp_path, "paid_keywords_zazzle_com.csv", "Url;Keyword;Title\nhttps://h/b;k2;head\n")
    put(tmp_path, "paid_keywords_merch_google.csv", "ERROR 10")
    rows = exports.read_keyword_exports(spark, str(tmp_path)).orderBy("Keyword").collect()
    assert [row.asDict() for row in rows] == [
        {"Keyword": "k1", "Url": "https://h/a", "Trends": "t", "domain": "merch.google", "source": "organic", "Title": None},
        {"Keyword": "k2", "Url": "https://h/b", "Trends": None, "domain": "zazzle.com", "source": "paid", "Title": "head"},
    ]


def test_rank_exports(spark, tmp_path):
    assert exports.read_rank_exports(spark, str(tmp_path)) is None
    header = ";".join(schemas.RANKS_EXPORT.names)
    put(tmp_path, "domain_ranks_b.csv", f"{header}\nb.com;2;10;20;30;;x;0;0;0\n")
    put(tmp_path, "domain_ranks_a.csv", f"{header}\na.com;1;11;21;31;5;6;0;0;0\n")
    put(tmp_path, "other.csv", "no;rank\n1;2\n")
    ranks = keywords.load_domain_ranks(exports.read_rank_exports(spark, str(tmp_path)), sample.SETTINGS)
    assert ranks.columns == [*schemas.RANK_COLUMNS.values(), "snapshot_date"]
    rows = {row.domain: (row.semrush_rank, row.paid_keywords, row.paid_traffic) for row in ranks.collect()}
    assert rows == {"a.com": (1, 5, 6), "b.com": (2, None, None)}


def test_export_schemas():
    assert {name: len(schema) for name, schema in schemas.EXPORTS.items()} == {
        "organic": 12,
        "paid": 10,
        "domain_ranks": 10,
        "backlinks": 8,
        "keyword_difficulty": 7,
    }
    needed = {"Keyword", "Position", "Search Volume", "CPC", "Traffic (%)", "Competition", "Url"}
    assert needed <= set(schemas.ORGANIC_EXPORT.names) & set(schemas.PAID_EXPORT.names)


def test_column_names(spark):
    names = {"Search Volume": "Search_Volume", "Traffic (%)": "Traffic_pct", "Organic-Cost": "Organic_Cost", "___messy___": "messy"}
    assert {name: keywords.clean_name(name) for name in names} == names
    with pytest.raises(ValueError):
        keywords.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))
    with pytest.raises(ValueError):
        keywords.clean_column_names(spark.range(1).select(F.lit(1).alias("A b"), F.lit(2).alias("a_B")))


def test_prepared_columns_and_extras(spark):
    rows = [("k", "https://h/cape/cap", "t", "merch.google", "organic"), ("l", "https://h/cap", "t", "zazzle.com", "paid")]
    raw = spark.createDataFrame(rows, ["Keyword", "Url", "Trends (12)", "domain", "source"])
    prepared = keywords.prepare_keywords(raw, sample.SETTINGS)
    leading = ["domain", "source", "snapshot_date", "Keyword", "Url", "page_path", "join_category", "joinable_to_ga4"]
    assert prepared.columns == [*leading, "Trends (12)"]
    flags = {row.Keyword: (row.join_category, row.joinable_to_ga4) for row in prepared.collect()}
    assert flags == {"k": ("apparel/headgear", True), "l": ("apparel/headgear", False)}
    assert keywords.load_keywords(prepared, sample.SETTINGS).columns[-1] == "Trends_12"


def test_snapshot_defaults_to_the_day_of_the_run(spark):
    raw = spark.createDataFrame([("k", "u", "d", "s")], ["Keyword", "Url", "domain", "source"])
    loaded = keywords.load_keywords(keywords.prepare_keywords(raw, MartSettings()), MartSettings())
    assert loaded.where(F.col("snapshot_date") == F.current_date()).count() == 1


def test_blank_categories(spark):
    prepared = spark.createDataFrame([("k", "", "", "7.0", "x")], ["Keyword", "join_category", "Position", "Search Volume", "CPC"])
    row = keywords.load_keywords(prepared, MartSettings()).first()
    assert (row.join_category, row.Position, row.Search_Volume, row.CPC) == (None, None, 7, None)
    assert keywords.load_keywords(prepared, MartSettings(keep_empty_text=True)).first().join_category == ""


def test_files_round_trip(spark, tmp_path, sf_dir):
    prepared = sample.prepared_keywords(spark, sf_dir)
    path = str(tmp_path / "all")
    for _ in range(2):
        files.write_csv(prepared, path)
    again = exports.read_export(spark, path, sep=",")
    loaded, reloaded = (keywords.load_keywords(frame, sample.SETTINGS) for frame in (prepared, again))
    assert loaded.exceptAll(reloaded).count() == reloaded.exceptAll(loaded).count() == 0
    files.write_csv_per_domain(prepared, str(tmp_path / "split"))
    assert sorted(name for name in os.listdir(tmp_path / "split") if "=" in name) == sorted(f"domain_key={key}" for key in DOMAINS)
    one = exports.read_export(spark, str(tmp_path / "split" / "domain_key=zazzle_com"), sep=",")
    assert one.count() == prepared.where("domain = 'zazzle.com'").count()


def test_top_keywords_keep_exact_places_in_a_crowded_group(spark):
    rows = spark.range(5000).select(
        F.lit("d").alias("domain"),
        F.when(F.col("id") % 10 == 0, "paid").otherwise("organic").alias("source"),
        (F.col("id") * 7919 % 997 / 10).alias("Traffic_pct"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("Keyword"),
        F.lit("u").alias("Url"),
    )
    got = {(row.source, row.Keyword) for row in keywords.top_keywords_per_domain(rows.repartition(13), 50).collect()}
    plain = rows.collect()
    wanted = set()
    for source in ("paid", "organic"):
        ranked = sorted((row for row in plain if row.source == source), key=lambda row: (-row.Traffic_pct, row.Keyword))
        wanted |= {(source, row.Keyword) for row in ranked[:50]}
    assert got == wanted


def test_event_readers_open_only_the_days_asked_for(spark, tmp_path, sf_dir):
    some = sample.events(spark, sf_dir)
    table, shards = str(tmp_path / "table"), str(tmp_path / "shards")
    some.write.partitionBy("event_date").parquet(table)
    for day in ("20240102", "20240103", "20240105"):
        some.where(F.col("event_date") == day).write.parquet(f"{shards}/events_{day}")
    wanted = some.where("event_date BETWEEN '20240102' AND '20240104'")
    by_partition = events.read_events(spark, table, "20240102", "20240104")
    by_shard = events.read_event_shards(spark, shards, "20240102", "20240104")
    assert by_partition.schema["event_date"].dataType == schemas.EVENTS["event_date"].dataType
    assert by_partition.count() == wanted.count()
    assert by_shard.count() == wanted.where("event_date < '20240104'").count()
    assert all("20240105" not in name for name in by_shard.inputFiles())
    assert {name.split("event_date=")[1][:8] for name in by_partition.inputFiles()} >= {"20240102"}
    assert "PartitionFilters: [isnotnull(event_date" in by_partition._jdf.queryExecution().executedPlan().toString()


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_blank_lines_before_the_header_are_skipped(spark, tmp_path):
    _file(tmp_path, "organic_keywords_a.csv", "\n\nKeyword;Url\nx;http://a/x\ny;http://a/y\n")
    found = exports.read_keyword_exports(spark, str(tmp_path), {"a": "a.com"})
    assert sorted(row.Keyword for row in found.collect()) == ["x", "y"]


def test_separator_is_no_pattern(spark, tmp_path):
    path = _file(tmp_path, "bars.csv", "a|b|c\n1|2|3\n4|5\n1|2|3|4\n")
    assert sorted(map(tuple, exports.read_export(spark, path, sep="|").collect())) == [("1", "2", "3"), ("4", "5", None)]


def test_refused_rank_files_are_skipped_and_long_rows_fail(spark, tmp_path):
    _file(tmp_path, "domain_ranks_a.csv", "ERROR 50 :: NOTHING FOUND\n")
    assert exports.read_rank_exports(spark, str(tmp_path)) is None
    _file(tmp_path, "domain_ranks_b.csv", "Domain;Rank\nb.com;1\n")
    assert exports.read_rank_exports(spark, str(tmp_path)).columns == ["Domain", "Rank"]
    _file(tmp_path, "domain_ranks_c.csv", "Domain;Rank\nc.com;1;2\n")
    with pytest.raises(Exception, match="more fields"):
        exports.read_rank_exports(spark, str(tmp_path)).collect()


def test_failed_rebuild_keeps_the_old_table(spark):
    tables.write_table(spark.range(5), "kept_rows")
    failing = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(failing, "kept_rows")
    assert spark.table("kept_rows").count() == 5
    assert tables.write_table(spark.range(7), "kept_rows").count() == 7
    assert not spark.catalog.tableExists("kept_rows__new")
