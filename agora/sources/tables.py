"""Stored tables: atomic replacement (K1), storage order across files (O1)
and buckets by the key that the facts join on (J1).

A table is a folder of versions, each a folder of Parquet files, and a
pointer: a file that names the current version.  ``replace_table`` writes a
new version first and then moves the pointer over in one step, so a write
that fails, or a driver lost half-way, leaves the table as it was, and a
reader sees either the old rows or the new ones.  The version replaced stays
until the next replacement, for readers that still have it; a table has one
writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.operators.keys import _ROW, Rows, in_scratch, remove, stored_rows

POINTER = "_current"
VERSION = "v-"
Sort = Sequence[tuple[str, bool]]  # (column, descending)


class _Folder:
    """A table's folder, on whatever file system it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.new_array = spark.sparkContext._gateway.new_array
        self.path = path.rstrip("/")
        self.files = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def pointer(self) -> str | None:
        if not self.files.exists(self.at(POINTER)):
            return None
        stream = self.files.open(self.at(POINTER))
        try:
            return self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()

    def versions(self) -> list[str]:
        if not self.files.exists(self.at("")):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(self.at("")) if s.getPath().getName().startswith(VERSION))

    def point_to(self, version: str) -> None:
        new = f"{POINTER}.{uuid.uuid4().hex}"
        stream = self.files.create(self.at(new))
        stream.writeBytes(version)
        stream.close()
        if self.files.getScheme() == "file":  # one rename of the operating system
            kind, move = self.jvm.java.nio.file.CopyOption, self.jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
            path = lambda name: self.jvm.java.nio.file.Paths.get(self.files.makeQualified(self.at(name)).toUri())
            self.jvm.java.nio.file.Files.move(path(new), path(POINTER), self._array(kind, move))
            for name in (new, POINTER):  # a checksum would be another file's
                self.files.delete(self.at(f".{name}.crc"), False)
        else:
            kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.conf) \
                .rename(self.at(new), self.at(POINTER), self._array(kind, kind.OVERWRITE))

    def _array(self, kind, value):
        one = self.new_array(kind, 1)
        one[0] = value
        return one


def _keys(sort: Sort):
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in sort]


def in_storage_order(df: DataFrame | Rows, sort: Sort, files: int | None = None) -> DataFrame:
    """``df`` dealt into ranges of ``sort``, so that each file holds one, and
    sorted in them: the statistics of files and row groups then let a reader
    skip what a filter on the leading columns can't meet.  A row number as last
    key splits a range of equal keys over several files.  Ranges are found in a
    pass of their own, so the rows are stored first, and computed once."""
    if not isinstance(df, Rows):
        df, path = stored_rows(df, "unordered")
        in_scratch(path)
    keys = _keys(sort)
    dealt = df.frame.repartitionByRange(*([files] if files else []), *keys, _ROW)
    return dealt.sortWithinPartitions(*keys).drop(_ROW)


def replace_table(df: DataFrame, path: str, sort: Sort = (), watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Makes ``df`` the table at ``path`` and reads it back.  ``sort``: its
    storage order.  ``watch`` may add observed metrics to what is written."""
    folder = _Folder(df.sparkSession, path)
    before, version = folder.pointer(), f"{VERSION}{uuid.uuid4().hex}"
    unordered, copy = stored_rows(df, "unordered") if sort else (None, None)
    out = in_storage_order(unordered, sort) if sort else df
    try:
        (watch(out) if watch else out).write.parquet(f"{folder.path}/{version}")
    except Exception:
        folder.files.delete(folder.at(version), True)
        raise
    finally:
        if copy:
            remove(df.sparkSession, copy)
    folder.point_to(version)
    for old in folder.versions():
        if old not in (before, version):
            folder.files.delete(folder.at(old), True)
    return read_table(df.sparkSession, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``."""
    folder = _Folder(spark, path)
    version = folder.pointer()
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{folder.path}/{version}")


def drop_table(spark: SparkSession, path: str) -> None:
    remove(spark, path)


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """``df`` stored as table ``name``, dealt into ``buckets`` by ``key`` and
    sorted in them.  Tables with the same key and number of buckets join on
    the key without an exchange.  Meant for keys of which none is hot, such as
    one row per commune: a bucket is one task."""
    dealt = df.repartition(buckets, F.col(key))  # each bucket one file
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
