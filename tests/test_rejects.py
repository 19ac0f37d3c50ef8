"""What readers and loads leave out is counted, kept and named."""

import logging
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from webmart import schemas
from webmart.operators import keywords
from webmart.settings import MartSettings
from webmart.sources import exports, sample


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_survey_finds_first_lines_and_counts(spark, tmp_path):
    put(tmp_path, "a.csv", "\n  \n﻿Keyword;Url\n\nx;y\n")
    put(tmp_path, "b c+d%.csv", "ERROR 50 :: NOTHING FOUND")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "blank.csv", "\n\n")
    found = {file.path.rsplit("/", 1)[1]: file for file in exports.surveyed(spark, f"{tmp_path}/*.csv")}
    assert {name: (file.first_line, file.lines, file.accepted) for name, file in found.items()} == {
        "a.csv": ("Keyword;Url", 2, True),
        "b c+d%.csv": ("ERROR 50 :: NOTHING FOUND", 1, False),
        "empty.csv": (None, 0, False),
        "blank.csv": (None, 0, False),
    }
    assert exports.surveyed(spark, f"{tmp_path}/*.txt") == []


def test_first_line_of_a_file_read_by_many_tasks(spark, tmp_path):
    put(tmp_path, "long.csv", "\n\nfirst;line\n" + "".join(f"{i};x\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert [(f.first_line, f.lines) for f in exports.surveyed(spark, f"{tmp_path}/long.csv")] == [("first;line", 20_001)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def jobs_of(spark, action):
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        action()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", 10_000)  # a listing job is Spark's own affair
    try:
        jobs = {}
        for count in (8, 300):
            root = tmp_path / str(count)
            root.mkdir()
            domains = {f"d{i}": f"d{i}.com" for i in range(count // 2)}
            for key in domains:
                put(root, f"organic_keywords_{key}.csv", f"Keyword;Url;Trends\n{key};https://h/{key};t\nlong;u;t;more\n")
                put(root, f"paid_keywords_{key}.csv", f"Url;Keyword;Title\nhttps://h/{key};{key};head\n")
            read = []
            jobs[count] = jobs_of(spark, lambda: read.extend(exports.read_keyword_exports(spark, str(root), domains).collect()))
            assert len(read) == count
            assert {(row.Keyword, row.domain) for row in read} == set(domains.items())
            assert exports.rejected_rows(spark, str(root), domains).count() == count // 2
        assert jobs[8] == jobs[300]
    finally:
        spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.threshold")


def test_rows_left_out_are_counted_in_the_same_pass_and_kept(spark, tmp_path):
    put(tmp_path, "organic_keywords_a.csv", 'Keyword;Url\nx;u\ny;u;z\n"q;q";u\n"q;q";u;"v;w"\n')
    put(tmp_path, "paid_keywords_b.csv", "Keyword;Url\nz;u;1;2\n")
    counts = Observation()
    domains = {"a": "a.com", "b": "b.com"}
    rows = exports.read_keyword_exports(spark, str(tmp_path), domains, counts=counts, with_file=True)
    assert sorted((row.Keyword, row.domain, row.export_file.rsplit("/", 1)[1]) for row in rows.collect()) == [
        ("q;q", "a.com", "organic_keywords_a.csv"),
        ("x", "a.com", "organic_keywords_a.csv"),
    ]
    assert counts.get == {"rows": 5, "rows_left_out": 3}
    rejected = exports.rejected_rows(spark, str(tmp_path), domains).collect()
    assert sorted((row.export_file.rsplit("/", 1)[1], row.row_text) for row in rejected) == [
        ("organic_keywords_a.csv", '"q;q";u;"v;w"'),
        ("organic_keywords_a.csv", "y;u;z"),
        ("paid_keywords_b.csv", "z;u;1;2"),
    ]


def test_lost_values_are_counted_in_the_same_pass_and_kept(spark):
    names = ["Keyword", "Position", "Search Volume", "CPC", "joinable_to_ga4", "snapshot_date", "domain"]
    rows = [
        ("a", "7", "1.0", "0.5", "TRUE", "2024-01-01", "d"),
        ("b", "7.5", "", "1,5", "yes", "yesterday", "d"),
        ("c", None, " ", "nan", " false ", None, "d"),
        ("d", "n/a", "1e3", "-", None, "", "d"),
    ]
    prepared = spark.createDataFrame(rows, names)
    losses = Observation()
    loaded = keywords.load_keywords(prepared, MartSettings(), losses)
    assert loaded.count() == 4
    assert losses.get == {
        "rows": 4, "Position": 2, "Search_Volume": 0, "CPC": 2, "joinable_to_ga4": 1, "snapshot_date": 1
    }
    kept = keywords.rejected_values(prepared)
    assert kept.columns == ["domain", "Keyword", "column", "text"]
    assert sorted((row.Keyword, row.column, row.text) for row in kept.collect()) == [
        ("b", "CPC", "1,5"),
        ("b", "Position", "7.5"),
        ("b", "joinable_to_ga4", "yes"),
        ("b", "snapshot_date", "yesterday"),
        ("d", "CPC", "-"),
        ("d", "Position", "n/a"),
    ]
    assert keywords.rejected_values(prepared.select("Keyword")).collect() == []


@pytest.mark.parametrize("family", list(schemas.EXPORTS))
def test_each_header_meets_its_contract(family):
    names = schemas.EXPORTS[family].names
    match = schemas.match_header(names)
    assert match.family == family and not match.departs
    changed = schemas.match_header([names[1], names[0], *names[3:], "Surprise"])
    assert (changed.family, changed.missing, changed.extra) == (family, [names[2]], ["Surprise"])
    assert set(changed.moved) == {names[0], names[1]}
    assert schemas.match_header(["no", "such"]).family is None


def test_headers_are_checked_while_reading(spark, tmp_path, caplog):
    header = ";".join(schemas.ORGANIC_EXPORT.names)
    put(tmp_path, "organic_keywords_a.csv", f"{header}\n" + ";".join("x" * 12) + "\n")
    put(tmp_path, "organic_keywords_b.csv", "Url;Keyword;Note\nu;k;n\n")
    with caplog.at_level(logging.WARNING):
        exports.read_keyword_exports(spark, str(tmp_path), {"a": "a.com", "b": "b.com"})
    warned = [record.getMessage() for record in caplog.records]
    assert not any("organic_keywords_a" in text for text in warned)
    assert any("organic_keywords_b" in text and "extra: Note" in text for text in warned)
    assert sum("no export paid_keywords" in text for text in warned) == 2
    found = {row.path.rsplit("/", 1)[1]: row for row in exports.export_check(spark, f"{tmp_path}/*.csv").collect()}
    assert found["organic_keywords_a.csv"].missing == [] and found["organic_keywords_a.csv"].lines == 2
    assert found["organic_keywords_b.csv"].extra == ["Note"]


def test_flawed_sample_exports_lose_what_they_should(spark, sf_dir, tmp_path):
    sample.write_keyword_exports(sample.keyword_exports(spark, sf_dir), str(tmp_path / "bad"), flawed=True)
    sample.write_keyword_exports(sample.keyword_exports(spark, sf_dir), str(tmp_path / "good"))
    bad, good = (exports.read_keyword_exports(spark, str(tmp_path / name)) for name in ("bad", "good"))
    refused = F.col("source").eqNullSafe("paid") & F.col("domain").eqNullSafe("zazzle.com")
    long_rows = exports.rejected_rows(spark, str(tmp_path / "bad")).count()
    assert long_rows > 0 and bad.count() + long_rows == good.where(~refused).count()
    assert exports.rejected_rows(spark, str(tmp_path / "good")).isEmpty()
