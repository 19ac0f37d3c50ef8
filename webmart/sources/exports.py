"""Readers of semicolon-separated keyword and rank exports.

A folder of exports is surveyed once: one job finds the first line of every file and counts its lines. Files that share a
header are then read together, whatever their number, and each row knows its file, from whose name domain and source
follow. Rows that do not fit their header are kept aside with their file and text (:func:`rejected_rows`).
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webmart import schemas
from webmart.settings import DOMAINS, KEYWORD_SOURCES

log = logging.getLogger(__name__)

_BAD_ROW, _LONG, _FILE = "_unparsed_row", "_too_long", "_file"
_ERROR_MARK = "ERROR"
#: The column that names the file of a row, where a reader is asked for it.
EXPORT_FILE = "export_file"
_KEYWORD_FILE = rf"/({'|'.join(KEYWORD_SOURCES)})_keywords_([^/]+)\.csv(?:/[^/]+)?$"


@dataclass(frozen=True)
class ExportFile:
    """One file of an export: its first line that is not blank, if any, and how many lines are not blank."""

    path: str
    first_line: str | None
    lines: int

    @property
    def accepted(self) -> bool:
        """Whether the body is data; one that starts with ERROR is a refusal."""
        return self.first_line is not None and not self.first_line.startswith(_ERROR_MARK)


def _plain_path(escaped: str) -> str:
    """A path as the readers take it; Spark names files with escapes."""
    return re.sub("^file:/+", "/", unquote(escaped))


def surveyed(spark: SparkSession, paths: str | list[str]) -> list[ExportFile]:
    """Every file that the paths or patterns name, by path; none if there is none.

    One listing and one job, whatever the number of files. Blank lines are passed over, as the reader skips them before
    the header. The lines of a file may lie in several tasks: the first one has the least offset of its block, then the
    least place in its task. The driver gets one row per file, as it lists the files anyway.
    """
    try:
        text = spark.read.text(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    lines = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
        F.regexp_replace("value", "^﻿", "").alias("value"),
    ).where(F.trim("value") != "")
    heads = lines.groupBy("path").agg(F.min_by("value", "at").alias("first_line"), F.count(F.lit(1)).alias("lines"))
    found = {_plain_path(row.path): (row.first_line, row.lines) for row in heads.collect()}
    listed = sorted(set(map(_plain_path, text.inputFiles())))
    return [ExportFile(path, *found.get(path, (None, 0))) for path in listed]


def column_names(header: str, sep: str = ";") -> list[str]:
    """Column names of a header line; a repeated name gets ``.1``, ``.2`` and so on."""
    seen: dict[str, int] = {}
    names = []
    for name in next(csv.reader([header], delimiter=sep)):
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def _parsed(spark: SparkSession, paths: list[str], names: list[str], sep: str, multiline: bool) -> DataFrame:
    """Rows of files with the same header, all columns as text, and for each row its file and what is wrong with it."""
    fields = [T.StructField(name, T.StringType()) for name in [*names, _BAD_ROW]]
    rows = (
        spark.read.schema(T.StructType(fields))
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # a row's field count shows only when all of its fields are parsed
        .option("columnNameOfCorruptRecord", _BAD_ROW)
        .csv(paths)
    )
    # Spark refuses a plan that reads nothing but the kept row text, so the test takes in a data column as well.
    nothing = F.left(F.col("`" + names[0].replace("`", "``") + "`"), F.lit(0))
    unquoted = F.regexp_replace(F.coalesce(_BAD_ROW, nothing, F.lit("")), r'"[^"]*"', "")
    too_long = F.size(F.split(unquoted, F.lit(rf"\Q{sep}\E"))) > len(names)
    return rows.withColumns({_LONG: too_long, _FILE: F.col("_metadata.file_path")})


def _all_rows(spark: SparkSession, files: Iterable[ExportFile], sep: str = ";", multiline: bool = False) -> DataFrame | None:
    """Rows of all files, one read for each header; None for no files."""
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in files:
        by_header[tuple(column_names(file.first_line, sep))].append(file.path)
    frames = [_parsed(spark, paths, list(names), sep, multiline) for names, paths in by_header.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames) if frames else None


def _fitting(rows: DataFrame, strict: bool, counts: Observation | None = None) -> DataFrame:
    """The rows without those of too many fields, which end the query if ``strict``; counted in the same pass."""
    if counts is not None:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(_LONG)).alias("rows_left_out"))
    fits = ~F.col(_LONG)
    if strict:
        refused = F.concat(
            F.lit("a row of "), F.col(_FILE), F.lit(" has more fields than its header: "), F.coalesce(_BAD_ROW, F.lit(""))
        )
        fits = F.when(fits, F.lit(True)).otherwise(F.raise_error(refused).cast("boolean"))
    return rows.where(fits).drop(_BAD_ROW, _LONG)


def read_export(
    spark: SparkSession, path: str, sep: str = ";", multiline: bool = False, strict: bool = False
) -> DataFrame:
    """Rows of one export, a file or a folder of files, all columns as text under the names of its header.

    Short rows are padded with NULL. Rows with more fields than the header are left out or, if ``strict``, end the
    query with an error. Blank lines are skipped, also before the header. Only an empty field is
    NULL. ``multiline`` admits line breaks inside quoted fields; such a file cannot be split between tasks.
    """
    files = [file for file in surveyed(spark, path) if file.first_line is not None]
    rows = _all_rows(spark, files, sep, multiline)
    if rows is None:
        return spark.createDataFrame([], T.StructType([]))
    return _fitting(rows, strict).drop(_FILE)


def export_check(spark: SparkSession, paths: str | list[str], sep: str = ";") -> DataFrame:
    """One row per export file: its first line, whether it is data, and how its header meets the contract.

    ``family`` is the kind of export whose columns it shares most; ``missing``, ``extra`` and ``moved`` list the columns
    that it lacks, that the kind does not have, and that stand in another order. All four are NULL for refused and empty files.
    """
    rows = []
    for file in surveyed(spark, paths):
        match = schemas.match_header(column_names(file.first_line, sep)) if file.accepted else None
        contract = (match.family, match.missing, match.extra, match.moved) if match else (None,) * 4
        rows.append((file.path, file.first_line, file.accepted, file.lines, *contract))
    kinds = "missing array<string>, extra array<string>, moved array<string>"
    return spark.createDataFrame(rows, f"path string, first_line string, accepted boolean, lines long, family string, {kinds}")


def export_status(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, first_line and accepted of :func:`export_check`."""
    return export_check(spark, paths).select("path", "first_line", "accepted")


def _accepted(files: list[ExportFile]) -> list[ExportFile]:
    """The files that hold data; each other one, and each header that departs from its contract, gets a warning."""
    for file in files:
        if not file.accepted:
            log.warning("empty or refused export at %s, skipped", file.path)
    accepted = [file for file in files if file.accepted]
    for header, own in groupby(sorted(accepted, key=lambda file: file.first_line), key=lambda file: file.first_line):
        match = schemas.match_header(column_names(header))
        if match.departs:
            first, *more = (file.path for file in own)
            log.warning("header of %s and %d more files: %s", first, len(more), match)
    return accepted


def _keyword_pattern(root: str) -> str:
    return f"{root}/{{{','.join(KEYWORD_SOURCES)}}}_keywords_*.csv"


def _export_name(path: Column, group: int) -> Column:
    return F.regexp_extract(path, _KEYWORD_FILE, group)


def _keyword_files(spark: SparkSession, root: str, domains: dict[str, str]) -> list[ExportFile]:
    wanted = {f"{source}_keywords_{key}.csv" for key in domains for source in KEYWORD_SOURCES}
    files = [file for file in surveyed(spark, _keyword_pattern(root)) if not wanted.isdisjoint(file.path.split("/")[-2:])]
    for name in sorted(wanted.difference(part for file in files for part in file.path.split("/")[-2:])):
        log.warning("no export %s under %s, skipped", name, root)
    return _accepted(files)


def read_keyword_exports(
    spark: SparkSession,
    root: str,
    domains: dict[str, str] | None = None,
    multiline: bool = False,
    counts: Observation | None = None,
    with_file: bool = False,
) -> DataFrame:
    """All ``<source>_keywords_<domain key>.csv`` under ``root``, tagged with domain and source.

    A missing or refused export is skipped with a warning; none at all is an error. ``counts`` observes rows read and
    rows left out for too many fields; ``with_file`` keeps the path of each row's file as ``export_file``.
    """
    domains = domains or DOMAINS
    rows = _all_rows(spark, _keyword_files(spark, root, domains), multiline=multiline)
    if rows is None:
        raise FileNotFoundError(f"no keyword exports under {root}")
    rows = _fitting(rows, strict=False, counts=counts)
    labels = F.create_map(*[F.lit(text) for pair in domains.items() for text in pair])
    path = F.col(_FILE)
    tagged = rows.withColumns({"domain": F.element_at(labels, _export_name(path, 2)), "source": _export_name(path, 1)})
    return (tagged.withColumn(EXPORT_FILE, path) if with_file else tagged).drop(_FILE)


def rejected_rows(
    spark: SparkSession, root: str, domains: dict[str, str] | None = None, multiline: bool = False
) -> DataFrame:
    """export_file and row_text of all rows of keyword exports that have more fields than their header."""
    rows = _all_rows(spark, _keyword_files(spark, root, domains or DOMAINS), multiline=multiline)
    if rows is None:
        return spark.createDataFrame([], f"{EXPORT_FILE} string, row_text string")
    return rows.where(_LONG).select(F.col(_FILE).alias(EXPORT_FILE), F.col(_BAD_ROW).alias("row_text"))


def read_rank_exports(spark: SparkSession, root: str) -> DataFrame | None:
    """All ``domain_ranks_*.csv`` under ``root`` in one frame; None, with a warning, when there are none.

    Empty and refused exports are skipped with a warning; a row with more fields than its header is an error.
    """
    rows = _all_rows(spark, _accepted(surveyed(spark, f"{root}/domain_ranks_*.csv")))
    if rows is None:
        log.warning("no rank exports under %s, skipped", root)
        return None
    return _fitting(rows, strict=True).drop(_FILE)
