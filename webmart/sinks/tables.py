"""Catalog tables, views and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Properties of the view that a table's name is, and of a version that was checked.
_VERSION, _ROWS = "webmart.version", "webmart.rows"


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")


def _parts(name: str) -> list[str]:
    """The parts of a table name, without back quotes."""
    return [quoted or plain for quoted, plain in re.findall(r"`([^`]+)`|([^.`]+)", name)]


def _quoted(parts: Sequence[str]) -> str:
    return ".".join(f"`{part}`" for part in parts)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


class VersionedTable:
    """A table whose rows are replaced as a whole, in one step of the catalog.

    Each rebuild writes a new table beside the earlier ones, ``<name>__v<number>_<random>``, and checks it. The table's
    own name is a view that reads one version; putting the next one in its place is one statement. Whatever fails, be
    it the computation, the check or that statement, readers of the name find the old rows. The version
    before the current one stays for readers that have begun; older and unfinished ones go when the next rebuild starts.
    Only one rebuild of a table may run at a time.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        *self.schema, self.table = _parts(name)
        self.name = _quoted([*self.schema, self.table])

    def _beside(self, table: str) -> str:
        return _quoted([*self.schema, table])

    def versions(self) -> list[str]:
        """All versions in the catalog, the latest first."""
        place = f" IN {_quoted(self.schema)}" if self.schema else ""
        rows = self.spark.sql(f"SHOW TABLES{place} LIKE '{self.table}__v*'").collect()
        pattern = re.compile(re.escape(self.table.lower()) + r"__v(\d+)_[0-9a-f]{8}")
        found = {row.tableName: pattern.fullmatch(row.tableName.lower()) for row in rows if not row.isTemporary}
        return sorted((name for name, match in found.items() if match), key=lambda name: -int(found[name][1]))

    def _number(self, version: str) -> int:
        return int(version[len(self.table) + 3 :].partition("_")[0])

    def current(self) -> str | None:
        """The version that the table's name reads, None if the name is not in the catalog."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        version = _properties(self.spark, self.name).get(_VERSION)
        if version is None:
            raise ValueError(f"{self.name} is a table or view that was not made by a rebuild")
        return version

    def recover(self) -> None:
        """Bring the catalog in order after a run that broke off.

        A name that is missing is put back on its latest checked version, and a plain table of that name becomes the first
        version. Versions that are neither read nor the last one before it are dropped.
        """
        if self.spark.catalog.tableExists(self.name) and self.spark.catalog.getTable(self.name).tableType != "VIEW":
            version = self._write(self.spark.table(self.name), self._partitioning())
            self.spark.sql(f"DROP TABLE {self.name}")
            self._switch(version)
        kept = self.versions()
        current = self.current()
        if current is None:
            current = next((v for v in kept if _ROWS in _properties(self.spark, self._beside(v))), None)
            if current is not None:
                self._switch(current)
        if current is None:
            previous = None
        else:
            earlier = (v for v in kept if self._number(v) < self._number(current))
            previous = next((v for v in earlier if _ROWS in _properties(self.spark, self._beside(v))), None)
        for version in kept:
            if version not in (current, previous):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._beside(version)}")

    def _partitioning(self) -> list[str]:
        return [column.name for column in self.spark.catalog.listColumns(self.name) if column.isPartition]

    def replace(self, frame: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace all rows by those of a frame; running it again changes nothing."""
        self.recover()
        self._switch(self._write(frame, partition_by))
        return self.spark.table(self.name)

    def _write(self, frame: DataFrame, partition_by: Sequence[str]) -> str:
        """A new, checked version that holds the frame's rows."""
        number = max(map(self._number, self.versions()), default=0) + 1
        version = f"{self.table}__v{number}_{uuid.uuid4().hex[:8]}"
        beside = self._beside(version)
        counted = Observation()
        rows = frame.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows = rows.hint("rebalance", *partition_by) if partition_by else rows
        writer = rows.write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.saveAsTable(beside)
            wanted = (counted.get["rows"], sorted(frame.columns))
            self._check(beside, wanted)
            self.spark.sql(f"ALTER TABLE {beside} SET TBLPROPERTIES ('{_ROWS}' = '{wanted[0]}')")
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
            raise
        return version

    def _check(self, beside: str, wanted: tuple[int, list[str]]) -> None:
        """Compare what can be read with the rows and columns that were counted while writing."""
        rows, _ = table_size(self.spark, beside)
        found = (rows, sorted(self.spark.table(beside).columns))
        if found != wanted:
            raise WriteMismatch(f"{self.name}: {wanted[0]} rows of {wanted[1]} written, {found[0]} of {found[1]} read back")

    def _switch(self, version: str) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_VERSION}' = '{version}') "
            f"AS SELECT * FROM {self._beside(version)}"
        )

    def drop(self) -> None:
        """Remove the name and all versions."""
        if self.current() is not None:
            self.spark.sql(f"DROP VIEW {self.name}")
        for version in self.versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._beside(version)}")


class WriteMismatch(RuntimeError):
    """The rows or columns read back after a write are not those that were written."""


def write_table(frame: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a Parquet table by the rows of a frame and read it back; see :class:`VersionedTable`.

    For a partitioned table the rows are first gathered by partition value; Spark splits values that hold too many rows
    for one task, so a crowded day does not end up in one file.
    """
    return VersionedTable(frame.sparkSession, name).replace(frame, partition_by)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a catalog view over a SELECT on saved tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def table_size(spark: SparkSession, name: str) -> tuple[int, int]:
    """Rows and columns of a saved table."""
    table = spark.table(name)
    return table.count(), len(table.columns)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared place that ``spark.checkpoint.dir`` names.

    Only a local session may do without that setting; on a cluster a machine's own temporary folder would be lost
    with the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/webmart-{uuid.uuid4().hex}"


class CatalogStore:
    """Keeps the tables of a build in catalog schemas."""

    def __init__(self, spark: SparkSession, staging: str = "staging", marts: str = "marts", reporting: str = "reporting"):
        self.schemas = {"staging": staging, "marts": marts, "reporting": reporting}
        for schema in self.schemas.values():
            ensure_schema(spark, schema)

    def save(self, layer: str, name: str, frame: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        return write_table(frame, f"`{self.schemas[layer]}`.`{name}`", partition_by)


class ScratchStore:
    """Keeps the tables of one query in a scratch folder.

    A table that several later steps read is computed once, its size is known to the planner, and it outlives the
    executors that wrote it.
    """

    def __init__(self, spark: SparkSession):
        self.root = scratch_folder(spark)

    def save(self, layer: str, name: str, frame: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.root}/{layer}/{name}"
        rows = frame.hint("rebalance", *partition_by) if partition_by else frame
        rows.write.partitionBy(*partition_by).parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path).select(*frame.columns)
