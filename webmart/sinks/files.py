"""Delimited files of prepared keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(frame: DataFrame, path: str, sep: str = ",") -> None:
    """All rows as delimited files with a header."""
    frame.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_csv_per_domain(frame: DataFrame, root: str) -> None:
    """One folder of delimited files per domain, ``domain_key=<domain with underscores>``; no row changes its task."""
    key = F.translate("domain", ". ", "__")
    writer = frame.withColumn("domain_key", key).write.mode("overwrite").partitionBy("domain_key")
    writer.option("header", True).option("escape", '"').csv(root)
