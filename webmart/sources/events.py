"""Event readers: a table partitioned by day, or one folder per day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmart import schemas

_DAY = "%Y%m%d"


def events_between(events: DataFrame, first: str, last: str) -> DataFrame:
    """Events of an inclusive ``yyyyMMdd`` range; on a table partitioned by ``event_date`` other days are not listed."""
    return events.where(F.col("event_date").between(first, last))


def read_events(spark: SparkSession, path: str, first: str, last: str, file_format: str = "parquet") -> DataFrame:
    """Events of a table whose rows (or ``event_date=`` folders) carry the day."""
    return events_between(spark.read.format(file_format).schema(schemas.EVENTS).load(path), first, last)


def read_event_shards(
    spark: SparkSession, root: str, first: str, last: str, file_format: str = "parquet"
) -> DataFrame:
    """Events of day shards ``<root>/events_yyyyMMdd``; days without a shard are skipped, other shards never opened."""
    day, end, days = datetime.strptime(first, _DAY), datetime.strptime(last, _DAY), []
    while day <= end:
        days.append(day.strftime(_DAY))
        day += timedelta(days=1)
    shards = f"{root}/events_{{{','.join(days)}}}"
    return spark.read.format(file_format).schema(schemas.EVENTS).load(shards)
