"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from webmart.sinks.tables import scratch_folder

Columns = dict[str, list]
_KEPT: dict[Hashable, Any] = {}


def saved(frame: DataFrame) -> DataFrame:
    """The frame written to the shared scratch folder and read again: computed once, safe from lost executors."""
    spark = frame.sparkSession
    path = scratch_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a schema string; needs a session, so not within tasks."""
    return to_arrow_schema(_parse_datatype_string(ddl))


def in_batches(
    frame: DataFrame, schema: str | StructType, start: Callable[[], Callable[[Columns], Columns]], rows: int = 512
) -> DataFrame:
    """Apply a function of columns, given as Python lists, to slices of at most ``rows`` rows of each partition.

    ``start`` runs once in each task and returns that function, so a model is set up once per task and not per row.
    """
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                made = apply({name: column.to_pylist() for name, column in zip(part.schema.names, part.columns)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[field.name], type=field.type) for field in arrow], schema=arrow
                )

    return frame.mapInArrow(run, schema)


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept in this Python worker between tasks until a task asks for another key.

    Spark gives one worker tasks of several operators in turn; only the model of the latest takes up memory.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def crc_fold(column: str = "doc_id", folds: int = 4) -> Column:
    """crc32 of a value's decimal text, modulo ``folds``; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def held_out(column: str = "doc_id") -> Column:
    """True for the fold that models never learn from."""
    return F.coalesce(crc_fold(column) == 2, F.lit(False))


def fresh(frame: DataFrame, name: str) -> str:
    """The name, with underscores added until no column has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(frame: DataFrame) -> list[Column]:
    """All columns by quoted name."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in frame.columns]
