"""Connected components of an edge table, by alternating stars.

Each round links every node's larger neighbours to its smallest one
(large star), then its smaller neighbours (small star), until nothing
changes; the edges left lead from each node to the smallest of its
component.  A round is joins and partial aggregates; its edges are
written to the shared folder, so no lineage grows and nothing is
collected but two check figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import store_at
from agora.operators.keys import in_scratch, remove


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``u, v`` (any order, ``u <> v``) to ``node, root``: ``root`` is the
    smallest node that ``node`` reaches.  Roots themselves are not listed."""
    edges, path = store_at(edges.select("u", "v"), "edges")
    seen = None
    while True:
        edges, now = store_at(_small_star(_large_star(edges)), "edges")
        remove(edges.sparkSession, path)  # its successor stands
        path = now
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            in_scratch(path)
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
