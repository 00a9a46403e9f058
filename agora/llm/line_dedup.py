"""Incremental and reversible removal of lines that many documents share.

``LineIndex`` keeps, in written tables:

* references: which document holds which line key, how often it was added
  (an insertion appends counts, a deletion their negatives);
* exact reference counts: per key, in how many documents it stands and the
  largest id among them;
* one cuckoo filter per shard of keys, holding the keys that have a count.

An insertion asks the filters first.  A key that its filter has never seen,
which is most of them, is new: its count comes from the inserted documents
alone.  For the others, few beside them, the exact tables decide: their
references are counted anew, which also unmasks a filter's false alarm.  A
deletion counts the keys of its documents anew; keys left without a document
leave the table and the filter.  So the index after a deletion is the one
that never saw the documents.

Scale: references go through a shuffle by key and document and are summed
per key before they meet, so a line of a third of all documents is one row
per task; shards get distinct keys only and are dealt by hash, of at most
``keys_per_shard`` keys when the index is made (further segments of the
filter take more).  Texts are read twice, and only documents that lose lines
join their verdict (see ``verdicts``).

A key is a line, stripped of ASCII white space and with A-Z lower-cased, of at
least ``min_chars`` code points, by its 128-bit hash.  Defined results: null
and empty text are one empty line; a document is what has one ``doc_id``, so
rows that repeat it count once and are deleted together; rows without an id
are one document that precedes all others; a key's lines all stay in its
largest document, repeated ones too; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import lower_ascii, store
from agora.llm.cuckoo import SLOTS, CuckooFilter
from agora.llm.verdicts import maybe_in

SPACE = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _text_hash() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, hash`` (of the text)``, pos, key``: the lines long enough."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("hash"),
                        F.posexplode(F.transform(lines, line_key)).alias("pos", "line"))
    return keyed.where(F.char_length("line") >= min_chars).select("doc_id", "hash", "pos", F.unhex(F.md5("line")).alias("key"))


def _filter(buckets: int, stored: pa.Table) -> CuckooFilter:
    return CuckooFilter(buckets, stored["filter"][0].as_py() if len(stored) else b"")


def _numbers(keys: pa.ChunkedArray) -> np.ndarray:
    """The first 64 bits of each key."""
    return np.frombuffer(b"".join(k[:8] for k in keys.to_pylist()), np.uint64)


@dataclass(frozen=True)
class LineIndex:
    """``references``: tables of ``key, doc_id, n``; ``counts``: ``key, n_docs,
    last_doc``; ``filters``: ``shard, filter``.  Operations return new ones."""
    min_chars: int
    shards: int
    buckets: int
    references: tuple[DataFrame, ...] = ()
    counts: DataFrame | None = None
    filters: DataFrame | None = None

    # ---- insertion and deletion

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with these documents in it as well."""
        added = store(lines_of(docs, self.min_chars).groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n")), "line-refs")
        asked = store(self._probed(_counted(added)), "line-probes")
        old = asked.where("seen").select("key")
        new = asked.where("not seen").select("key", "n_docs", "last_doc")
        return self._changed(added, old, new)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose ``doc_id`` is in ``ids``."""
        if self.counts is None:
            return self
        ids = ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        held = reduce(DataFrame.unionByName, self.references) \
            .join(ids, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi").groupBy("key", "doc_id").agg(F.sum("n").alias("n"))
        taken = store(held.where("n <> 0").withColumn("n", -F.col("n")), "line-refs")
        return self._changed(taken, taken.select("key").distinct(), None)

    def _changed(self, delta: DataFrame, old: DataFrame, new: DataFrame | None) -> LineIndex:
        """``old``: keys to count anew from all references; ``new``: counts of others."""
        references = (*self.references, delta)
        recounted = _counted(reduce(DataFrame.unionByName, references).join(old, "key", "left_semi")
                             .groupBy("key", "doc_id").agg(F.sum("n").alias("n")).where("n > 0"))
        if self.counts is None:
            kept, before = recounted, None
        else:
            before = self.counts.join(old, "key", "left_semi").select("key")
            kept = self.counts.join(old, "key", "left_anti").unionByName(recounted)
        counts = store(kept if new is None else kept.unionByName(new), "line-counts")
        if before is None:
            change = counts.select("key", F.lit(1).alias("by"))
        else:
            # keys that came to have a count (+1) or no longer have one (-1)
            now = recounted.select("key", F.lit(1).alias("by")).unionByName(before.select("key", F.lit(-1).alias("by")))
            change = now.groupBy("key").agg(F.sum("by").alias("by")).where("by <> 0")
            if new is not None:
                change = change.unionByName(new.select("key", F.lit(1).alias("by")))
        return replace(self, references=references, counts=counts, filters=store(self._refiltered(change), "line-filters"))

    # ---- filters

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _with_filters(self, rows: DataFrame, run, schema: str) -> DataFrame:
        filters = self.filters if self.filters is not None else \
            rows.sparkSession.createDataFrame([], "shard int, filter binary")
        return rows.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, schema)

    def _probed(self, counted: DataFrame) -> DataFrame:
        """``counted`` with ``seen``: whether the shard's filter may hold the key."""
        if self.filters is None:
            return counted.withColumn("seen", F.lit(False))
        buckets = self.buckets

        def run(rows: pa.Table, stored: pa.Table) -> pa.Table:
            seen = _filter(buckets, stored).contains(_numbers(rows["key"]))
            return rows.drop_columns(["shard"]).append_column("seen", pa.array(seen))

        return self._with_filters(counted.select("*", self._shard()), run, "key binary, n_docs long, last_doc long, seen boolean")

    def _refiltered(self, change: DataFrame) -> DataFrame:
        """The filters with some keys added (``by`` 1) and others removed (-1)."""
        buckets = self.buckets

        def run(rows: pa.Table, stored: pa.Table) -> pa.Table:
            f = _filter(buckets, stored)
            keys, by = _numbers(rows["key"]), rows["by"].to_numpy()
            f.remove(keys[by < 0])
            f.add(keys[by > 0])
            shard = (rows if len(rows) else stored)["shard"][0].as_py()
            return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([f.to_bytes()], pa.binary())})

        return self._with_filters(change.select("key", F.col("by").cast("int").alias("by"), self._shard()), run, "shard int, filter binary")

    # ---- cleaning

    def clean(self, docs: DataFrame, min_docs: int = 3) -> DataFrame:
        """``doc_id, n_lines, n_dropped, kept`` (the text left) of each row of
        ``docs``, whose documents are in the index."""
        shared = self.counts.where(F.col("n_docs") >= min_docs).select("key", "last_doc")
        lost = store(lines_of(docs, self.min_chars).join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
                     .groupBy("doc_id", "hash").agg(F.collect_set("pos").alias("gone")), "line-verdicts")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("hash"),
                           F.coalesce("text", F.lit("")).alias("text"))
        both = F.xxhash64("doc_id", "hash")
        rows = maybe_in(rows, both, lost.select(both.alias("h")), "some")
        none = F.array().cast("array<int>")
        whole = rows.where("not some").select("doc_id", "text", none.alias("gone"))
        of = lost.select(F.col("doc_id").alias("of_doc"), F.col("hash").alias("of_hash"), "gone")
        cut = rows.where("some").join(of, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_hash")), "left") \
            .select("doc_id", "text", F.coalesce("gone", none).alias("gone"))
        return whole.unionByName(cut).withColumn("lines", F.split("text", "\n", -1)) \
            .withColumn("left", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")) \
            .select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                    F.when(F.size("gone") == 0, F.col("text")).otherwise(
                        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n")).alias("kept"))


def _counted(held: DataFrame) -> DataFrame:
    """Reference counts of distinct (key, doc_id)."""
    return held.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def line_index(docs: DataFrame, min_chars: int = 20, keys_per_shard: int = 1 << 17, shards: int | None = None) -> LineIndex:
    """An empty index sized for documents like ``docs``."""
    if shards is None:
        lines = docs.select(F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n")).agg(F.sum("n")).first()[0] or 0
        shards = max(1, -(-lines // keys_per_shard))
    buckets = 1
    while buckets * SLOTS * 0.9 < keys_per_shard:
        buckets *= 2
    return LineIndex(min_chars, shards, buckets)


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 2, **sizes) -> DataFrame:
    """All of ``docs`` inserted, batch after batch, and cleaned."""
    index = line_index(docs, min_chars, **sizes)
    for b in range(batches):
        index = index.insert(docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)) == b))
    return index.clean(docs, min_docs)
