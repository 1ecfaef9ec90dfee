"""Where a dataset lives: a folder of Parquet tables or a catalog schema."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from finloom.sources.record import Record, read_note, read_record, write_note, write_record

ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


@dataclass(frozen=True)
class Location:
    """One place for both writing and checking. Give ``path`` (any Hadoop file system) or ``schema``."""

    path: str | None = None
    schema: str | None = None
    suffix: str = ""

    def __post_init__(self):
        if (self.path is None) == (self.schema is None):
            raise ValueError("a location is either a path or a schema")

    def name(self, table: str) -> str:
        if self.schema is not None:
            return ".".join(f"`{part}`" for part in (*self.schema.split("."), table))
        return f"{self.path.rstrip('/')}/{table}{self.suffix}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.schema is not None:
            return spark.table(self.name(table))
        record = read_record(spark, self.name(table))
        reader = spark.read.schema(record.schema) if record else spark.read
        return reader.parquet(self.name(table))

    def find(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The table, or None when there is none."""
        if self.schema is not None and not spark.catalog.tableExists(self.name(table)):
            return None
        try:
            return self.read(spark, table)
        except AnalysisException as error:
            if error.getCondition() in ABSENT:
                return None
            raise

    def exists(self, spark: SparkSession, table: str) -> bool:
        return self.find(spark, table) is not None

    def partitioning(self, spark: SparkSession, table: str) -> tuple[str, ...] | None:
        """The columns a table is partitioned by, in order; None for files without a record."""
        if self.schema is not None:
            return tuple(c.name for c in spark.catalog.listColumns(self.name(table)) if c.isPartition)
        record = read_record(spark, self.name(table))
        return record.partition_by if record else None

    def take_on(self, spark: SparkSession, table: str, before: StructType | None, after: StructType,
                partition_by: Sequence[str]) -> None:
        """Make ``after`` the columns of the table, ahead of rows that need them."""
        if self.schema is None:
            record = read_record(spark, self.name(table))
            if record is None or record.schema != after:
                version = record.version + 1 if record else 1
                write_record(spark, self.name(table), Record(after, tuple(partition_by), version))
        elif before is not None:
            known = {field.name: field.dataType for field in before.fields}
            wide = [f.name for f in after.fields if known.get(f.name, f.dataType) != f.dataType]
            if wide:
                raise ValueError(f"{table}: a catalog's Parquet table can't widen {wide}")
            new = [f"`{f.name}` {f.dataType.simpleString()}" for f in after.fields if f.name not in known]
            if new:
                spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({', '.join(new)})")

    def note(self, spark: SparkSession, table: str, name: str, text: str) -> None:
        """Keep a text with the table until it is overwritten: beside its files, or as a property in the catalog."""
        if self.schema is None:
            write_note(spark, self.name(table), name, text)
        else:
            said = text.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('finloom.{name}' = '{said}')")

    def noted(self, spark: SparkSession, table: str, name: str) -> str | None:
        if self.schema is None:
            return read_note(spark, self.name(table), name)
        if not spark.catalog.tableExists(self.name(table)):
            return None
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where(f"key = 'finloom.{name}'").collect()
        return rows[0]["value"] if rows else None

    def ensure(self, spark: SparkSession) -> None:
        if self.schema is not None:
            quoted = ".".join(f"`{part}`" for part in self.schema.split("."))
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted}")


def shared_folder(spark: SparkSession, purpose: str) -> Location:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session without that setting may use the temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return Location(path=f"{base.rstrip('/')}/finloom-{purpose}-{uuid.uuid4().hex}")


def passing_folder(spark: SparkSession, purpose: str) -> Location:
    """A shared folder that the file system drops when the session ends."""
    found = shared_folder(spark, purpose)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found.path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return found
