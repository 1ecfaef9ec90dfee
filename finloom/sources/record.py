"""What a table stored by path is declared to hold: columns and partitioning, in versioned files beside its data.

Parquet files each carry a schema of their own, and partition columns have none at all. The record is what a reader
goes by: older files then show columns added since as NULL, and narrower types as the wider ones they became. Names
begin with an underscore, which Spark's readers pass over.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

STEM = "_finloom-schema-"


class ConcurrentChange(RuntimeError):
    """Another writer recorded a schema of the same version first."""


@dataclass(frozen=True)
class Record:
    schema: StructType
    partition_by: tuple[str, ...] = ()
    version: int = 1


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _text_of(spark: SparkSession, files, path) -> str:
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_note(spark: SparkSession, path: str, name: str) -> str | None:
    """A text kept beside a table's data, or None. It goes when the table is overwritten."""
    place, files = _place(spark, f"{path.rstrip('/')}/_finloom-{name}")
    return _text_of(spark, files, place) if files.exists(place) else None


def write_note(spark: SparkSession, path: str, name: str, text: str) -> None:
    place, files = _place(spark, f"{path.rstrip('/')}/_finloom-{name}")
    stream = files.create(place)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_record(spark: SparkSession, path: str) -> Record | None:
    """The newest record of a table, or None where it has none."""
    found, files = _place(spark, f"{path.rstrip('/')}/{STEM}*.json")
    newest = max((status.getPath() for status in files.globStatus(found) or ()), key=lambda p: p.getName(), default=None)
    if newest is None:
        return None
    held = json.loads(_text_of(spark, files, newest))
    return Record(StructType.fromJson(held["schema"]), tuple(held["partition_by"]), held["version"])


def write_record(spark: SparkSession, path: str, record: Record) -> None:
    """Record a version; readers see it whole or not at all."""
    final, files = _place(spark, f"{path.rstrip('/')}/{STEM}{record.version:08d}.json")
    passing, _ = _place(spark, f"{path.rstrip('/')}/_finloom-{uuid.uuid4().hex}.tmp")
    text = json.dumps({"version": record.version, "partition_by": list(record.partition_by),
                       "schema": record.schema.jsonValue()})
    stream = files.create(passing)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(final) or not files.rename(passing, final):
        files.delete(passing, False)
        raise ConcurrentChange(f"{path}: version {record.version} of the schema is there already")
