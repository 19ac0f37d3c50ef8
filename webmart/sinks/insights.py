"""The append-only log of insight texts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webmart import schemas

# Fixed value: the kind of insight the channel brief leads to.
CHANNEL_INSIGHT = "channel_recommendation"


def create_insights_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the log unless it exists, partitioned by the day of ``generated_at``."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()} NOT NULL" for field in schemas.INSIGHTS)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, generated_date DATE) "
        f"USING parquet PARTITIONED BY (generated_date){place}"
    )


def utc(moment: Column) -> Column:
    """A moment as UTC wall-clock time, whatever the session's time zone."""
    return F.to_utc_timestamp(moment, F.current_timezone())


def _required(name: str) -> Column:
    missing = F.raise_error(F.lit(f"insight column {name} must not be NULL"))
    return F.when(F.col(name).isNull(), missing).otherwise(F.col(name)).alias(name)


def insight_rows(texts: DataFrame, kind: str = CHANNEL_INSIGHT, at: datetime | None = None) -> DataFrame:
    """Log rows for a frame with ``insight_text``; Parquet tables do not enforce NOT NULL, so the rows check it."""
    now = F.current_timestamp() if at is None else F.lit(at)
    stamped = texts.select(
        now.alias("generated_at"), F.lit(kind).alias("insight_type"), "insight_text", now.alias("created_at")
    )
    checked = stamped.select(*[_required(field.name) for field in schemas.INSIGHTS])
    return checked.withColumn("generated_date", F.to_date(utc(F.col("generated_at"))))


def append_insights(texts: DataFrame, table: str, kind: str = CHANNEL_INSIGHT, at: datetime | None = None) -> None:
    """Append texts to the log table; a NULL fails the write and nothing is added."""
    insight_rows(texts, kind, at).write.insertInto(table)


def append_insight_files(texts: DataFrame, path: str, kind: str = CHANNEL_INSIGHT, at: datetime | None = None) -> None:
    """The same for a log kept as plain files."""
    insight_rows(texts, kind, at).write.mode("append").partitionBy("generated_date").parquet(path)
