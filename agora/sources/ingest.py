"""Raw landing audit (K7, I1, I2).

The download itself is network I/O and stays outside Spark.  What Spark
does is the audit: a manifest of expected files (category, file name,
url) is matched against the listing of what actually landed in the raw
zone -- e.g. ``spark.read.format("binaryFile")`` metadata, whose
``length`` comes from the file system without reading the content -- and
every manifest entry gets a status, an object path and a size.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.operators.keys import freeze

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
LISTING_TASKS = 1000

STATUS_OK = "OK"
STATUS_DOWNLOAD_ERROR = "ERREUR_DOWNLOAD"
STATUS_STORE_ERROR = "ERREUR_MINIO"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("url", T.StringType()),
])


def manifest_frame(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Manifest from a list of ``{category, filename, url}`` entries."""
    return spark.createDataFrame([(e["category"], e["filename"], e["url"]) for e in entries],
                                 MANIFEST_SCHEMA)


def _children(batches):
    """Names and sizes in each folder, from the file system that holds it."""
    import pyarrow as pa
    from pyarrow import fs

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])
    for batch in batches:
        for uri in batch["path"].to_pylist():
            files, path = (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)
            root = uri[:len(uri) - len(path)] if uri.endswith(path) else ""
            found = [f for f in files.get_file_info(fs.FileSelector(path)) if not f.base_name.startswith(("_", "."))]
            if found:
                yield pa.RecordBatch.from_pydict({
                    "path": [root + f.path for f in found], "length": [f.size or 0 for f in found],
                    "folder": [f.type == fs.FileType.Directory for f in found]}, schema)


def landed_listing(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Files under ``root`` (the bucket's folder) with their size and their
    object path ``bucket/<path below root>``; metadata only, content not read.

    Folders are listed in tasks, level by level: a level is a table of the
    folders found in the one before, and no name comes to the driver.  Names
    with a leading ``_`` or ``.`` are not files of the zone; empty files are."""
    below = re.sub("/+", "/", re.sub(_SCHEME, "", root)).rstrip("/")
    if not below.startswith("/"):
        raise ValueError(f"the root must be an absolute path or a URI: {root}")
    local = re.match("(file:)?/", root)
    here = below if local else root.rstrip("/")
    level, files = spark.createDataFrame([(here,)], "path string"), []
    pending = 1
    while pending:
        # a task takes a few folders, whose sizes nobody knows yet
        spread = level.repartition(min(pending, LISTING_TASKS), F.xxhash64("path"))
        listed = freeze(spread.mapInArrow(_children, "path string, length long, folder boolean"), "listing")
        files.append(listed.where("not folder"))
        level = listed.where("folder").select("path")
        pending = level.count()
    rel = F.substring("path", len(below) + 2, 1 << 20)
    return reduce(DataFrame.unionByName, files).select(F.regexp_replace("path", _SCHEME, "").alias("path"), "length") \
        .select("path", "length", F.concat_ws("/", F.lit(bucket), rel).alias("object_path"))


def landing_report(manifest: DataFrame, landed: DataFrame, bucket: str, prefix: str,
                   landed_key: str = "object_path", manifest_key: str = "object_path",
                   uploaded_at: _dt.datetime | None = None) -> DataFrame:
    """One row per manifest entry.

    ``OK`` rows carry ``category, object_path (bucket/prefix/category/file),
    size_bytes, uploaded_at``; an entry with nothing landed is
    ``ERREUR_DOWNLOAD``; one whose object name is empty cannot be stored
    (``ERREUR_MINIO``).  Error rows carry ``error`` instead.
    The landed side is reduced to one row per key first, so a key repeated
    many times never multiplies rows in the join.
    """
    rel = F.concat_ws("/", F.lit(prefix), F.col("category"), F.col("filename"))
    m = manifest.withColumn("object_path", F.concat_ws("/", F.lit(bucket), rel))
    sizes = (landed.groupBy(F.col(landed_key).alias("__lk"))
                   .agg(F.max("length").cast("long").alias("__len")))
    j = m.join(sizes, F.col(manifest_key) == F.col("__lk"), "left")
    status = (F.when(F.col("__len").isNull(), STATUS_DOWNLOAD_ERROR)
               .when(F.coalesce(F.col("filename"), F.lit("")) == "", STATUS_STORE_ERROR)
               .otherwise(STATUS_OK))
    ok = status == STATUS_OK
    ts = F.lit(uploaded_at).cast("timestamp") if uploaded_at else F.current_timestamp()
    return j.select(
        *[c for c in manifest.columns if c not in ("category", "filename", "url")],
        F.col("url"),
        F.col("filename").alias("dataset"),
        F.when(ok, F.col("category")).alias("category"),
        F.when(ok, F.col("object_path")).alias("object_path"),
        F.when(ok, F.col("__len")).alias("size_bytes"),
        status.alias("status"),
        F.when(~ok, F.when(status == STATUS_DOWNLOAD_ERROR, F.lit("contenu absent"))
                     .otherwise(F.lit("nom d'objet vide"))).alias("error"),
        F.when(ok, ts).alias("uploaded_at"))


def ingest_summary(report: DataFrame) -> DataFrame:
    """Outcome tally: files and bytes per status, and the total count."""
    per = report.groupBy("status").agg(F.count(F.lit(1)).alias("nb_fichiers"),
                                       F.sum("size_bytes").cast("long").alias("total_octets"))
    # at most three statuses: the window below sees a handful of rows
    return per.withColumn("nb_total", F.sum("nb_fichiers").over(Window.partitionBy()).cast("long"))
