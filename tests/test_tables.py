"""Rebuilds of saved tables, and what is left of them after failures."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from webmart.sinks import tables
from webmart.sinks.tables import VersionedTable


def days(spark, count, extra=0):
    rows = spark.range(count).select("id", (F.col("id") % 3).alias("day"))
    return rows.withColumn("extra", F.lit(extra)) if extra else rows


def failing(spark):
    bad = F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no such row")))
    return spark.range(10).select(bad.alias("id"), (F.col("id") % 3).alias("day"))


@pytest.fixture(params=[(), ("day",)], ids=["plain", "partitioned"])
def kept(spark, request):
    name = f"kept_{len(request.param)}"
    VersionedTable(spark, name).drop()
    tables.write_table(days(spark, 5), name, request.param)
    yield VersionedTable(spark, name), request.param
    VersionedTable(spark, name).drop()


def ids(spark, table):
    return sorted(row.id for row in spark.table(table.name).collect())


def test_failed_computation_keeps_the_old_rows(spark, kept):
    table, partition_by = kept
    before = table.current()
    for _ in range(2):
        with pytest.raises(Exception, match="no such row"):
            table.replace(failing(spark), partition_by)
        assert ids(spark, table) == [0, 1, 2, 3, 4]
        assert table.versions() == [before]


def test_failed_switch_keeps_the_old_rows_and_so_does_a_failed_rerun(spark, kept, monkeypatch):
    table, partition_by = kept
    before = table.current()

    def broken(self, version):
        raise RuntimeError("the catalog is away")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_switch", broken)
        with pytest.raises(RuntimeError, match="away"):
            table.replace(days(spark, 7), partition_by)
    assert ids(spark, table) == [0, 1, 2, 3, 4] and len(table.versions()) == 2
    with pytest.raises(Exception, match="no such row"):
        table.replace(failing(spark), partition_by)
    assert ids(spark, table) == [0, 1, 2, 3, 4] and table.versions() == [before]
    table.replace(days(spark, 9), partition_by)
    assert len(ids(spark, table)) == 9


def test_a_write_that_reads_back_differently_keeps_the_old_rows(spark, kept, monkeypatch):
    table, partition_by = kept
    with monkeypatch.context() as patched:
        patched.setattr(tables, "table_size", lambda spark, name: (6, 2))
        with pytest.raises(tables.WriteMismatch, match="7 rows"):
            table.replace(days(spark, 7), partition_by)
    assert ids(spark, table) == [0, 1, 2, 3, 4] and len(table.versions()) == 1


def test_rebuilds_keep_one_earlier_version(spark, kept):
    table, partition_by = kept
    reader = spark.table(table.name)
    seen = [table.current()]
    for count in (6, 7, 8):
        table.replace(days(spark, count, extra=count), partition_by)
        seen.append(table.current())
        assert len(ids(spark, table)) == count
        if count == 6:  # a reader that began before the switch can still finish
            assert reader.count() == 5
    assert spark.table(table.name).columns == (["id", "day", "extra"] if not partition_by else ["id", "extra", "day"])
    assert table.versions() == [seen[3], seen[2], seen[1]]
    table.recover()
    assert table.versions() == [seen[3], seen[2]]


def test_a_missing_name_comes_back_with_its_last_checked_version(spark, kept):
    table, partition_by = kept
    table.replace(days(spark, 6), partition_by)
    spark.sql(f"DROP VIEW {table.name}")
    table.spark.range(3).write.saveAsTable(f"{table.table}__v99_00000000")  # written, never checked
    with pytest.raises(Exception, match="no such row"):
        table.replace(failing(spark), partition_by)
    assert ids(spark, table) == [0, 1, 2, 3, 4, 5]
    assert len(table.versions()) == 2


def test_a_plain_table_becomes_the_first_version(spark):
    spark.sql("DROP TABLE IF EXISTS older")
    days(spark, 4).write.partitionBy("day").saveAsTable("older")
    table = VersionedTable(spark, "older")
    with pytest.raises(Exception, match="no such row"):
        table.replace(failing(spark), ["day"])
    assert ids(spark, table) == [0, 1, 2, 3]
    table.replace(days(spark, 5), ["day"])
    assert ids(spark, table) == [0, 1, 2, 3, 4]
    table.drop()


def test_views_of_others_are_left_alone(spark):
    spark.sql("CREATE OR REPLACE VIEW someones AS SELECT 1 AS id")
    with pytest.raises(ValueError, match="not made by a rebuild"):
        tables.write_table(spark.range(3), "someones")
    assert spark.table("someones").count() == 1
    spark.sql("DROP VIEW someones")


def test_names_with_a_schema_and_odd_signs(spark):
    tables.ensure_schema(spark, "odd_schema")
    for count in (3, 4):
        assert tables.write_table(spark.range(count), "`odd_schema`.`T_1`").count() == count
    assert tables.table_size(spark, "`odd_schema`.`T_1`") == (4, 1)
    VersionedTable(spark, "`odd_schema`.`T_1`").drop()
    assert spark.sql("SHOW TABLES IN `odd_schema`").where("NOT isTemporary").count() == 0


def test_partitions_of_a_version_are_pruned(spark, kept):
    table, partition_by = kept
    if partition_by:
        plan = spark.table(table.name).where("day = 1")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan


def test_registered_rebuild(spark, sf_dir):
    first, second = (entry.queries()["table_rebuild"](spark, sf_dir).collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, second)) and first
