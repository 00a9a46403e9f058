"""Raw zone readers: CSV files read as text, never with type inference.

Inference would turn a code such as ``01001`` into the number 1001 and
break the prefix filters, so every raw column is a ``StringType``.
Delimiter, quoting and encoding are options because the source files do
not state them.

Spark takes the header of one file for a whole path, so files of a folder
whose columns stand in another order would be read by position.  Here the
headers are read first, one line per file in a task per file, and files
with the same header are scanned together, each group by its own names.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: No file is as long as this: it makes each file one split, and each split one task.
_WHOLE_FILES = str(1 << 42)
#: Rows of a task that makes many columns of each.
SPREAD_ROWS = 25_000


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def file_headers(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``file, header``: the first line of every file below ``paths`` (files,
    folders or globs) that has one.  A task reads the start of its file only."""
    own = spark.newSession()  # the split sizes below hold for this scan alone
    own.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILES)
    own.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILES)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.schema("line string").option("header", False).option("sep", "\x01").option("quote", "") \
        .option("encoding", encoding).csv(paths if isinstance(paths, str) else list(paths))

    def first_line(batches):
        yield from (b for b, _ in zip(batches, range(1)))

    return lines.select(F.col("_metadata.file_path").alias("file"), F.ltrim(F.col("line"), F.lit("\ufeff")).alias("header")) \
        .mapInArrow(first_line, "file string, header string")


def _names(header: str, sep: str, quote: str, escape: str) -> list[str]:
    same = escape == quote
    return next(csv.reader([header], delimiter=sep, quotechar=quote, doublequote=same, escapechar=None if same else escape))


def _literal(file: str) -> str:
    """A listed file's path as one to read: nothing in it is a pattern."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", unquote(file))


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                  sep: str = ",", encoding: str = "UTF-8", header: bool = True, quote: str = '"',
                  escape: str = '"', multi_line: bool = False) -> DataFrame:
    """Read one or many CSV files, folders or globs as one relation of text columns.

    With a header (one line) each file is read by its own column names:
    further columns and another order do no harm; a file without one of
    ``columns``, or with one of them twice, is an error.  Files without a
    line are empty.  Without a header, ``columns`` name the fields by
    position.  ``multi_line`` lets a quoted value hold line breaks; such a
    file is not split.

    Only distinct headers come to the driver; with more than one of them,
    so do the paths of their files, which a reader needs to be given.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    reader = (spark.read.option("header", header).option("sep", sep)
                   .option("encoding", encoding).option("quote", quote).option("escape", escape)
                   .option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if not header:
        return reader.schema(text_schema(columns)).csv(paths)
    files = file_headers(spark, paths, encoding)
    groups = files.groupBy("header").agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("n")).orderBy("file").collect()
    if not groups:
        raise ValueError(f"no file with a header: {paths}")
    parts = []
    for g in groups:
        found = _names(g["header"], sep, quote, escape)
        for problem, wrong in (("no column", [c for c in columns if c not in found]),
                               ("more than one column", [c for c in columns if found.count(c) > 1])):
            if wrong:
                raise ValueError(f"{g['file']} has {problem} {', '.join(wrong)}; it has {', '.join(found)}")
        unique = [c if c in columns else f"__other{i}" for i, c in enumerate(found)]
        own = paths if len(groups) == 1 else [_literal(r["file"]) for r in files.where(F.col("header") == g["header"]).select("file").collect()]
        parts.append(reader.schema(text_schema(unique)).csv(own).select(*[F.col(f"`{c}`") for c in columns]))
    return reduce(DataFrame.unionByName, parts)


def spread_rows(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """``df`` dealt out, about ``rows`` to a task.  A scan is split by bytes and
    row groups; where much is made of each short row, that leaves a narrow
    table's work to one task.  Deal the few columns that are read, before any
    work on them.  The count reads the footers of Parquet files only."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
