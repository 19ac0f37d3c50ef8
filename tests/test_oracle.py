"""Every registered query against its DuckDB statement."""

import math
import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    plain = [tuple(_plain(record[place]) for place in order) for record in records]
    return sorted(columns), sorted(plain, key=repr)


def test_every_query_has_a_statement():
    assert set(entry.mart_queries()) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.mart_queries()))
def test_query_equals_statement(spark, duck, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    mine = rows(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(entry.oracle_sql()[name])
    theirs = rows([column[0] for column in result.description], result.fetchall())
    assert mine[0] == theirs[0]
    assert len(mine[1]) == len(theirs[1])
    assert mine[1] == theirs[1]
