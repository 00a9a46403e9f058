"""Partition-wise shares and ranks (window operators W1, W2, O4).

Both survive a hot partition key (one key holding a large share of all
rows):

* ``share_of_partition`` pre-aggregates the partition totals (map-side
  partial sums, one row per key) and joins them back, instead of a
  whole-partition window that would buffer the hot key in one task.
* ``rank_desc`` counts the rows of a stored table by key; what is too much
  for one task is reduced to distinct ``(key, value)`` pairs with their
  multiplicities and range-partitioned, so a key's values span many tasks.

The keys join as one struct: equal structs may hold NULLs (NULL keys form
one group, as in ``PARTITION BY``), and being a plain equality on the
grouping key the join goes when nobody reads its result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.keys import (_MID, _PID, _ROW, ROWS_PER_PARTITION, Rows, freeze, in_scratch, range_layout,
                                  stored_rows)

_KEY = "__agora_key"


def share_of_partition(df: DataFrame, value: str, partition_by: Sequence[str],
                       out: str, percent: bool = True) -> DataFrame:
    """``CASE WHEN SUM(v) OVER (PARTITION BY k) = 0 THEN 0
    ELSE v * 100 / SUM(v) OVER (PARTITION BY k) END``.

    A NULL partition total (all values NULL) gives NULL.
    """
    total = "__agora_total"
    totals = df.groupBy(F.struct(*partition_by).alias(_KEY)).agg(F.sum(value).alias(total))
    return _join_back(df, totals, list(partition_by)).withColumn(out, _share(value, total, percent)).drop(total)


def ordered_shares(df: DataFrame, value: str, partition_by: Sequence[str], out: str,
                   order_by: Sequence[Column], percent: bool = True) -> DataFrame:
    """``share_of_partition`` with the result in ``order_by`` order, from one
    scan of ``df``: its rows are written once, range-partitioned by the order
    (with a row number as last key, so that neither a hot partition key nor
    equal rows stay in one task) and meet the partition totals there.  Totals
    small enough to broadcast leave the order as it is; larger ones join by a
    shuffle and the rows are sorted after it."""
    rows, path = stored_rows(df)
    in_scratch(path)
    total = "__agora_total"
    totals = rows.frame.groupBy(F.struct(*partition_by).alias(_KEY)).agg(F.sum(value).alias(total))
    laid = rows.frame.repartitionByRange(*order_by, _ROW).sortWithinPartitions(*order_by, _ROW)
    return _join_back(laid, totals, list(partition_by)).withColumn(out, _share(value, total, percent)) \
        .drop(total, _ROW).orderBy(*order_by)


def rank_desc(df: DataFrame | Rows, value: str, partition_by: Sequence[str], out: str,
              num_partitions: int | None = None, hot_rows: int = ROWS_PER_PARTITION) -> DataFrame | Rows:
    """``RANK() OVER (PARTITION BY k ORDER BY value DESC NULLS LAST)`` (int).

    The rows are stored once (given ``Rows``, they are, and ``Rows`` come
    back).  Keys of up to ``hot_rows`` rows rank in a window, a key at a time;
    those beyond it, of which there can only be count / ``hot_rows``, rank by
    their distinct values laid out over many tasks."""
    rows, path = (df, None) if isinstance(df, Rows) else stored_rows(df)
    if path:
        in_scratch(path)
    keys = list(partition_by)
    at = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    if rows.count <= hot_rows:
        ranked = rows.frame.withColumn(out, F.rank().over(at))
    else:
        hot = freeze(rows.frame.groupBy(F.struct(*keys).alias(_KEY)).agg(F.count(F.lit(1)).alias("n"))
                         .where(F.col("n") > hot_rows).select(_KEY), "hot-keys")
        is_hot = F.struct(*keys) == F.col(_KEY)
        ranked = rows.frame.join(hot, is_hot, "left_anti").withColumn(out, F.rank().over(at))
        if not hot.isEmpty():
            ranked = ranked.unionByName(_ranked_apart(rows.frame.join(hot, is_hot, "left_semi"), value, keys, out, num_partitions))
    return Rows(ranked, rows.count) if isinstance(df, Rows) else ranked.drop(_ROW)


def _ranked_apart(df: DataFrame, value: str, keys: list[str], out: str, num_partitions: int | None) -> DataFrame:
    """Ranks without a key's rows ever in one task: its distinct values, with
    their multiplicities, lie in several ranges; each counts on from those
    before it."""
    n, before = "__agora_n", "__agora_before"
    pairs = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(n))
    laid = range_layout(pairs, [*keys, F.col(value).desc_nulls_last()], num_partitions)
    so_far = Window.partitionBy(_PID, *keys).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per key and partition that holds some of it
    offsets = (laid.groupBy(_PID, *keys).agg(F.sum(n).alias("__agora_in"))
                   .select(F.struct(_PID, *keys).alias(_KEY), F.coalesce(F.sum("__agora_in").over(earlier), F.lit(0)).alias(before)))
    ranked = laid.withColumn("__agora_here", F.coalesce(F.sum(n).over(so_far), F.lit(0)))
    ranked = _join_back(ranked, offsets, [_PID, *keys]).select(
        F.struct(*keys, value).alias(_KEY), (F.col(before) + F.col("__agora_here") + 1).cast("int").alias(out))
    return _join_back(df, ranked, [*keys, value])


def _share(value: str, total: str, percent: bool) -> Column:
    scale = 100.0 if percent else 1.0
    return (F.when(F.col(total) == 0, F.lit(0.0))
             .otherwise(F.col(value).cast("double") * scale / F.col(total).cast("double")))


def _join_back(df: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(right, F.struct(*keys) == F.col(_KEY), "left").drop(_KEY)
