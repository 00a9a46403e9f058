"""Pivot, fill, patch and grouped-ratio operators (A2-A4, B2p, B3)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.clean import pct_guarded


def pivot_avg(df: DataFrame, keys: Sequence[str], category: str | Column,
              value: Column, outputs: dict[str, str]) -> DataFrame:
    """Conditional-average pivot: one ``AVG(CASE WHEN category = c THEN value END)``
    column per ``outputs`` entry (category value -> output column).

    A single grouped aggregate (partial + final hash aggregate); categories
    not listed contribute nothing and a key with no matching row still gets
    a row, with NULL measures.
    """
    cat = F.col(category) if isinstance(category, str) else category
    aggs = [F.avg(F.when(cat == c, value)).alias(out) for c, out in outputs.items()]
    return df.groupBy(*keys).agg(*aggs)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``COALESCE(c, 0)`` on the named measures, other columns untouched."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType).alias(c)
                       if c in columns else F.col(c) for c in df.columns])


def append_rows(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """``INSERT INTO t (cols) VALUES ...`` by name: columns not given are NULL,
    values are cast to the table's types."""
    if not rows:
        return df
    spark = df.sparkSession
    lit_rows = []
    for r in rows:
        unknown = set(r) - set(df.columns)
        if unknown:
            raise KeyError(f"unknown columns {sorted(unknown)}")
        lit_rows.append(F.struct(*[
            (F.lit(r[c]) if c in r else F.lit(None)).cast(df.schema[c].dataType).alias(c)
            for c in df.columns]))
    patch = spark.range(1).select(F.inline(F.array(*lit_rows)))
    return df.unionByName(patch)


def grouped_sums_with_ratios(df: DataFrame, keys: Sequence[str],
                             measures: dict[str, Column],
                             ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """``GROUP BY keys`` of ``SUM(measure)`` then zero-guarded percentage
    ratios between the sums (``den = 0 -> 0``; NULL sum -> NULL ratio)."""
    agg = df.groupBy(*keys).agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])
    return agg.withColumns({name: pct_guarded(num, den) for name, (num, den) in ratios.items()})


def with_provenance(df: DataFrame, source: str | Column, load_ts: _dt.datetime | None = None) -> DataFrame:
    """Append ``date_chargement`` (injected load time) and ``source_fichier``."""
    ts = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({"date_chargement": ts, "source_fichier": src})
