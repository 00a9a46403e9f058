"""Exact dedup: group by a 128-bit content hash, compare the bytes inside
each group, keep one stable id.

DataFrame functions only.  Texts are equal when identical after
lower-casing A-Z; null counts as empty.  Rows are grouped by hash *and*
normalised text, so the comparison inside a hash group is one of bytes
and two texts that share a hash stay apart.  The aggregation is partial
before the shuffle: a group holding a third of all rows sends one row
per map task.  What joins back to the documents is the narrow group
table, over an inner join whose skewed keys adaptive execution splits.

Defined results: null and empty text are one group; a null ``doc_id``
never stays while another id of its group is there; rows that repeat a
``doc_id`` and text count in ``group_size`` and share one verdict;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import lower_ascii, store
from agora.llm.verdicts import maybe_in, named_rows, without


def exact_dedup(docs: DataFrame, keep: str = "smallest",
                content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep``: which id of a group stays, ``smallest`` or ``largest``.
    ``content_hash``: the 128-bit hash; it only has to be equal for equal
    texts, as the groups are compared by bytes.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    norm = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm")) \
        .withColumn("hash", content_hash(F.col("norm")))
    groups = norm.groupBy("hash", "norm").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")) \
        .select("hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    rows = norm.select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256"))
    return rows.join(groups, ["hash", "text_sha256"]) \
        .select("doc_id", "keep_id", "group_size",
                F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, keep: str = "smallest",
                content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row of each text stays, with its own columns: the one with the
    ``keep`` id, a null id last.  Among rows that share id and text a hash of
    their other columns decides, then their place in the files.

    A narrow table of hashes, with what ranks the rows, is written first.
    Texts travel only for rows whose hash is not theirs alone: grouped by hash
    *and* bytes, partial before the shuffle.  Then the rows lost are taken out
    in place (see ``verdicts``)."""
    def contains_map(kind) -> bool:
        return "map<" in kind.simpleString()

    norm = lower_ascii(F.coalesce("doc.text", F.lit("")))
    rows = named_rows(docs)
    others = [F.col(f"doc.`{f.name}`") for f in docs.schema if not contains_map(f.dataType)]
    no_id = F.col("doc.doc_id").isNull()
    pick, first = {"smallest": (F.min, no_id), "largest": (F.max, ~no_id)}[keep]
    rank = F.struct(first.alias("a"), F.col("doc.doc_id").alias("b"), F.xxhash64(*others).alias("c"), "row")
    hashes = store(rows.select(content_hash(norm).alias("hash"), rank.alias("rank")), "hashes")
    shared = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    met = store(hashes.join(shared, "hash", "left_semi").select("hash", "rank", F.col("rank.row").alias("met")), "shared-hashes")
    near = maybe_in(rows, F.xxhash64("row"), met.select(F.xxhash64("met").alias("h")), "some").where("some") \
        .join(met, F.col("row") == F.col("met")).select("hash", norm.alias("norm"), "rank")
    stay = near.groupBy("hash", "norm").agg(pick("rank").alias("stay")).select(F.col("stay.row").alias("stay"))
    lost = store(met.join(stay, F.col("met") == F.col("stay"), "left_anti").select(F.col("met").alias("lost")), "copies")
    return without(rows, lost)
