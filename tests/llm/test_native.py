"""Mixing and URL filters: against their SQL, on odd rows, and without Python in their plans."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from webmart.llm import mixing, queries, url_filter
from webmart.llm.common import saved


@pytest.mark.parametrize("name", ["op7_mixing", "op9_url_filter"])
def test_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = queries.queries()[name](spark, sf_dir)
    result = duck.execute(queries.oracle_sql()[name])
    order = [column[0] for column in result.description]
    assert sorted(order) == sorted(frame.columns)
    theirs = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(row) for row in frame.select(*order).collect()), key=repr) == theirs
    assert "Python" not in frame._jdf.queryExecution().toString() and "Arrow" not in frame._jdf.queryExecution().toString()


def test_raked_margins_reach_their_targets(spark):
    rows = [(f"s{s}", f"l{l}", "t", 100 + 37 * s + 11 * l * s) for s in range(4) for l in range(3)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    total = sum(row[3] for row in rows)
    shares = {
        "source": spark.createDataFrame([(f"s{s}", 0.25) for s in range(4)], "source string, share double"),
        "lang": spark.createDataFrame([("l0", 0.5), ("l1", 0.3), ("l2", 0.2)], "lang string, share double"),
        "topic": spark.createDataFrame([("t", 1.0)], "topic string, share double"),
    }
    raked = mixing.rake(cells, shares, budget=0.2, rounds=20).join(cells, list(mixing.MARGINS))
    for margin, target in (("source", {f"s{s}": 0.25 for s in range(4)}), ("lang", {"l0": 0.5, "l1": 0.3, "l2": 0.2})):
        sums = raked.groupBy(margin).agg(F.sum(F.col("probability") * F.col("tokens")).alias("w")).collect()
        assert {row[margin]: round(row.w / total / 0.2, 3) for row in sums} == target


def test_plans_of_raking_stay_small(spark, monkeypatch):
    joins = []

    def counted(frame):
        joins.append(frame._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return saved(frame)

    monkeypatch.setattr(mixing, "saved", counted)
    rows = [(f"s{s}", f"l{l}", "t", 100 + 37 * s + 11 * l * s) for s in range(4) for l in range(3)]
    raked = mixing.rake(spark.createDataFrame(rows, "source string, lang string, topic string, tokens long"), rounds=2)
    assert raked.count() == len(rows)
    assert max(joins) <= len(mixing.MARGINS)


@pytest.mark.parametrize("name", ["odd", "none", "clashing"])
def test_mixture_of_odd_rows(request, name):
    docs = request.getfixturevalue(name)
    found = mixing.mixture(docs).collect()
    assert len(found) == docs.count()
    assert all(0 <= row.probability <= 1 for row in found)
    drawn = mixing.sample(docs)
    assert drawn.columns == docs.columns
    assert drawn.count() == sum(row.sampled for row in found)
    whole = mixing.sample(docs, budget=10.0)
    assert whole.count() == docs.count()


ENTRIES = [
    ("a", "host", "example.com", date(2024, 1, 10), "add"),
    ("a", "host", "example.com", date(2024, 3, 1), "remove"),
    ("a", "host", "example.com", date(2024, 5, 1), "add"),
    ("a", "host", "example.com", date(2024, 5, 1), "remove"),
    ("b", "url", "www.example.com/x/y", date(2024, 2, 1), "add"),
    ("c", "host", "com", date(2024, 1, 1), "add"),
    ("d", "host", None, date(2024, 1, 1), "add"),
    ("e", "host", "late.org", None, "add"),
]
CAPTURES = [
    (1, "https://www.Example.com/x/y/?q=1#z", date(2024, 1, 9)),
    (2, "https://www.Example.com/x/y/?q=1#z", date(2024, 1, 10)),
    (3, "https://www.example.com/x/y", date(2024, 2, 29)),
    (4, "http://example.com:80/x/y", date(2024, 3, 1)),
    (5, "http://user.example.com", date(2024, 6, 1)),
    (6, "http://notexample.com/", date(2024, 6, 1)),
    (7, None, date(2024, 6, 1)),
    (8, "http://example.com/", None),
    (9, "no url", date(2024, 6, 1)),
    (9, "no url", date(2024, 6, 1)),
    (None, "http://late.org/", date(2024, 6, 1)),
]


def test_lists_apply_while_they_are_valid(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, pattern string, listed_on date, action string")
    captures = spark.createDataFrame(CAPTURES, "page_id long, url string, fetched_on date")
    found = url_filter.judge(captures, entries).collect()
    assert {row.page_id: row.lists for row in found} == {
        1: "", 2: "a", 3: "a,b", 4: "", 5: "a", 6: "", 7: "", 8: "", 9: "", None: "",
    }
    assert len(found) == 10 and all(row.blocked == (row.lists != "") for row in found)


def test_empty_tables_and_lists(spark):
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, pattern string, listed_on date, action string")
    captures = spark.createDataFrame(CAPTURES, "page_id long, url string, fetched_on date")
    assert url_filter.judge(captures.limit(0), entries).count() == 0
    assert not any(row.blocked for row in url_filter.judge(captures, entries.limit(0)).collect())
    clashing = captures.withColumns({name: F.lit("own") for name in ("kind", "pattern", "month", "lists", "p", "starts")})
    assert url_filter.judge(clashing, entries).count() == 10


def test_an_interval_without_an_end_stays_open(spark):
    entries = [("a", "host", "x.com", date(2024, 1, 5), "add"), ("b", "host", "x.com", date(2024, 1, 5), "add"),
               ("b", "host", "x.com", date(2090, 1, 1), "remove")]
    entries = spark.createDataFrame(entries, "list string, kind string, pattern string, listed_on date, action string")
    days = [date(2024, 1, 4), date(2024, 1, 5), date(2099, 12, 31), date(2100, 1, 1), date(2345, 6, 7)]
    rows = [(n, "http://x.com/p", day) for n, day in enumerate(days)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    found = {row.page_id: row.lists for row in url_filter.judge(captures, entries).collect()}
    assert found == {0: "", 1: "a,b", 2: "a", 3: "a", 4: "a"}
