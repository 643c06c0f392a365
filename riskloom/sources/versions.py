"""Versions of a layer and the pointer that says which of them is current.

A new version is written beside the old ones.  Only when all of it is there is
the pointer moved, so a write that fails, or a reader that comes in between,
finds the version before.  Versions that are no longer needed are dropped after
that; the one before the current stays, for those who are still reading it.

Of a layer by path, ``_versions`` holds the data and ``_current`` one small
file per version, of which the last counts.  It is written aside and renamed,
and names the folder and the columns.  Of a layer by name, the versions are
tables of their own and the pointer is a view.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEPT = 2
VERSIONS, CURRENT = "_versions", "_current"


class _Folder:
    """The few calls on a folder of any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.system = self._new(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, part: str) -> list[str]:
        folder = self._new(f"{self.path}/{part}")
        if not self.system.exists(folder):
            return []
        found = [status.getPath().getName() for status in self.system.listStatus(folder)]
        return sorted(name for name in found if name[:1].isdigit())

    def read(self, name: str) -> str:
        stream = self.system.open(self._new(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Whether ``name`` is new and now holds ``text``, all at once."""
        aside = self._new(f"{self.path}/{CURRENT}/.{uuid.uuid4().hex}")
        stream = self.system.create(aside)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        final = self._new(f"{self.path}/{name}")
        if not self.system.exists(final) and self.system.rename(aside, final):
            return True
        self.system.delete(aside, False)
        return False

    def drop(self, name: str) -> None:
        self.system.delete(self._new(f"{self.path}/{name}"), True)


def _pointer(folder: _Folder) -> dict | None:
    names = folder.names(CURRENT)
    return json.loads(folder.read(f"{CURRENT}/{names[-1]}")) if names else None


def write_path(df: DataFrame, path: str, partition_by: str | None) -> None:
    folder = _Folder(df.sparkSession, path)
    name = uuid.uuid4().hex
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    try:
        writer.parquet(f"{folder.path}/{VERSIONS}/0-{name}")
    except Exception:
        folder.drop(f"{VERSIONS}/0-{name}")
        raise
    text = json.dumps({"folder": f"0-{name}", "schema": df.schema.jsonValue()})
    while True:  # another writer may take the number first
        last = folder.names(CURRENT)
        if folder.put(f"{CURRENT}/{int(last[-1]) + 1 if last else 1:09d}", text):
            break
    for old in folder.names(CURRENT)[:-KEPT]:
        expired = json.loads(folder.read(f"{CURRENT}/{old}"))
        folder.drop(f"{CURRENT}/{old}")
        folder.drop(f"{VERSIONS}/{expired['folder']}")


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The current version, or plain Parquet files where there are no versions."""
    pointer = _pointer(_Folder(spark, path))
    if pointer is None:
        return spark.read.parquet(path)
    schema = StructType.fromJson(pointer["schema"])
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{VERSIONS}/{pointer['folder']}").select(
        *[f"`{name}`" for name in schema.names])


def _version_tables(spark: SparkSession, name: str) -> list[str]:
    database, _, table = name.rpartition(".")
    listed = spark.catalog.listTables(database or spark.catalog.currentDatabase(), f"{table}__*")
    form = re.compile(re.escape(table.lower()) + r"__(\d{9})$")
    found = [t.name for t in listed if not t.isTemporary and form.match(t.name.lower())]
    return [f"{database}.{t}" if database else t for t in sorted(found)]


def write_table(df: DataFrame, name: str, partition_by: str | None) -> None:
    spark = df.sparkSession
    last = _version_tables(spark, name)
    version = f"{name}__{int(last[-1][-9:]) + 1 if last else 1:09d}"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    try:
        writer.format("parquet").saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in _version_tables(spark, name)[:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
