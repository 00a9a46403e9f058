"""Filtering documents by verdicts without shuffling the others' texts.

A verdict (this row goes, these lines go) is narrow, but a join would send
every document through the shuffle once the verdicts outgrow a broadcast.
Here a bitmap of the verdicts' hashes, of a bounded size, tells apart in
place the documents that surely have none; only the rest is joined.  The
bitmap grows with the number of verdicts up to ``MOST_BITS`` (so its
broadcast is bounded); beyond that more documents take part in the join,
and the result stays the same.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from agora.llm.common import store

PER_BITMAP = 1 << 15  # bits in one of Spark's bitmaps
MOST_BITS = 1 << 27


def named_rows(docs: DataFrame) -> DataFrame:
    """``doc`` (a struct of the row's own columns, so that no other name here
    can clash with one of them) and ``row``, a name of the stored row: its
    file and its place in it.

    The same row has the same name in every scan, however files are split.
    What isn't read from Parquet files is stored first.  A file is named by a
    64-bit hash of its path."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    try:
        file = docs.metadataColumn("_metadata")
        here = F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("place"))
        return docs.select(doc, here.alias("row"))
    except AnalysisException:  # no file source: no such column
        return named_rows(store(docs, "rows"))


def maybe_in(docs: DataFrame, hashed: Column, members: DataFrame, flag: str) -> DataFrame:
    """``docs`` with a boolean ``flag``: false only if ``hashed`` (a long) is
    surely not in the long column ``h`` of ``members``."""
    n = members.count()
    bits = PER_BITMAP
    while bits < min(64 * n, MOST_BITS):
        bits *= 2
    bit = F.pmod(F.col("h"), F.lit(bits))
    maps = members.select(bit.alias("bit")).groupBy(F.expr(f"bit div {PER_BITMAP}").alias("__map")) \
        .agg(F.bitmap_construct_agg(F.expr(f"bit % {PER_BITMAP}")).alias("__bits"))  # at most MOST_BITS / 8 bytes in all
    byte = f"cast(conv(hex(substring(__bits, cast(__bit % {PER_BITMAP} div 8 as int) + 1, 1)), 16, 10) as int)"
    is_set = F.expr(f"coalesce(shiftright({byte}, cast(__bit % 8 as int)) & 1 = 1, false)")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    placed = docs.select("*", F.pmod(hashed, F.lit(bits)).alias("__bit")).withColumn("__map", F.expr(f"__bit div {PER_BITMAP}"))
    return placed.join(F.broadcast(maps), "__map", "left").select(*kept, is_set.alias(flag))


def without(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """The documents of ``rows`` (see ``named_rows``) whose name isn't in the
    stored column ``lost``; only what the bitmap can't tell apart is joined."""
    flagged = maybe_in(rows, F.xxhash64("row"), lost.select(F.xxhash64("lost").alias("h")), "judged")
    judged = flagged.where("judged").join(lost.select("lost"), F.col("row") == F.col("lost"), "left_anti")
    return flagged.where("not judged").select("doc.*").unionByName(judged.select("doc.*"))
