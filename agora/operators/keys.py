"""Dense surrogate keys: ``ROW_NUMBER() OVER (ORDER BY ...)`` at scale.

A plain global window sends every row to one partition.  Here the rows
are written once with a row number of their own, so the input is computed
a single time, and counted by that write.  Up to ``ROWS_PER_PARTITION`` of
them are one partition anyway and get their numbers in it.  A larger table
is range-partitioned on the order key with the
row number as last tie-breaker (Spark samples the key, so neither a hot
leading value nor rows with one and the same key end up in one task),
sorted inside each partition and written again with its partition id.
The per-partition row counts then give each partition its offset.  Both
tables lie in the shared folder named by ``spark.checkpoint.dir``: losing
an executor loses nothing.  The first is removed as soon as the second
stands; ``scratch`` removes the others once their result is stored.  Rows
that a caller has stored already (``Rows``) are not written again.

With residual ties the numbering among fully identical rows is arbitrary,
exactly as for ``ROW_NUMBER``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from agora.session import ensure_checkpoint_dir

_PID = "__agora_pid"
_MID = "__agora_mid"
_OFF = "__agora_off"
_ROW = "__agora_row"
ROWS_PER_PARTITION = 1_000_000
#: Open ``scratch`` blocks, innermost last: the folders each will remove.
_scratch: list[list[str]] = []


def _ordered(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


@dataclass(frozen=True)
class Rows:
    """Rows computed once: a frame over a written table, with a row number
    (``_ROW``) that every selection must carry along, and their count."""
    frame: DataFrame
    count: int

    def select(self, *cols: Column | str) -> Rows:
        return Rows(self.frame.select(*cols, _ROW), self.count)

    @property
    def partitions(self) -> int:
        return max(1, -(-self.count // ROWS_PER_PARTITION))


def stored_rows(df: DataFrame, name: str = "rows") -> tuple[Rows, str]:
    """``df`` written once with row numbers, counted by the write itself; the
    path, for the caller to remove or leave to a scratch block."""
    seen = Observation()
    once, path = _written(df.withColumn(_ROW, F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("n")), name)
    return Rows(once, seen.get["n"]), path


def range_layout(df: DataFrame | Rows, order_by: Sequence[Column | str], num_partitions: int | None = None) -> DataFrame:
    """The rows written in ``order_by`` order, with their partition id and
    their place in the partition.  Partitions hold about
    ``ROWS_PER_PARTITION`` rows, whatever the session's shuffle setting.
    What isn't stored yet is written first, so that it is computed once."""
    path = None
    if not isinstance(df, Rows):
        df, path = stored_rows(df)
    n = num_partitions or df.partitions
    ordered = [*_ordered(order_by), F.col(_ROW)]
    laid_out = freeze(df.frame.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
                        .withColumn(_PID, F.spark_partition_id())
                        .withColumn(_MID, F.monotonically_increasing_id()).drop(_ROW))
    if path:
        remove(laid_out.sparkSession, path)
    return laid_out


def dense_key(df: DataFrame | Rows, order_by: Sequence[Column | str], name: str,
              num_partitions: int | None = None, reused: bool = False) -> DataFrame:
    """Add ``name`` (bigint, 1..n) numbering rows in ``order_by`` order.

    ``order_by`` items are column names (ascending, NULLs last) or sort
    expressions such as ``F.col("x").desc_nulls_last()``.  Rows that make up
    one partition, as counted when they were stored, are numbered right there;
    a result that several plans read (``reused``) is then written, so that it
    is numbered once.
    """
    path = None
    if not isinstance(df, Rows):
        df, path = stored_rows(df)
    if (num_partitions or df.partitions) == 1:
        numbered = small_dense_key(df.frame, [*_ordered(order_by), F.col(_ROW)], name).drop(_ROW)
        if reused:
            numbered = freeze(numbered, "numbered")
        if path and reused:
            remove(numbered.sparkSession, path)
        elif path:
            in_scratch(path)
        return numbered
    frozen = range_layout(df, order_by, num_partitions)
    if path:
        remove(frozen.sparkSession, path)
    # One row per partition: bounded by the partition count, safe to broadcast.
    offsets = (frozen.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
                     .withColumn(_OFF, F.coalesce(
                         F.sum("__n").over(Window.orderBy(_PID).rowsBetween(
                             Window.unboundedPreceding, -1)), F.lit(0)))
                     .drop("__n"))
    local_index = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (frozen.join(F.broadcast(offsets), _PID)
                  .withColumn(name, (F.col(_OFF) + local_index + 1).cast("long"))
                  .drop(_PID, _MID, _OFF))


def small_dense_key(df: DataFrame, order_by: Sequence[Column | str], name: str) -> DataFrame:
    """Window ``row_number`` for inputs with a known bound (calendar days,
    literal code lists, counted rows of one partition)."""
    w = Window.orderBy(*_ordered(order_by))
    return df.withColumn(name, F.row_number().over(w).cast("long"))


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/agora-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: no footer inference on read-back
    return spark.read.schema(df.schema).parquet(path), path


def freeze(df: DataFrame, name: str = "frozen") -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage like a reliable checkpoint (the files live in the
    cluster's shared folder, so losing an executor loses nothing) and
    computes the input a single time.
    """
    out, path = _written(df, name)
    in_scratch(path)
    return out


def in_scratch(path: str) -> None:
    """Leaves a written table to the innermost open ``scratch`` block, if any."""
    if _scratch:
        _scratch[-1].append(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one written table, on whatever file system it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables frozen inside the block when it ends; whatever
    depends on them must be stored by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)
