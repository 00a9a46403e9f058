"""Benchmark decontamination with suffix arrays of the training shards.

A shard is a bounded run of documents.  Its words become numbers of the
benchmark's vocabulary (0: a word that no item has), its suffixes are
sorted by their first ``window`` words, and every test suffix is binary
searched in that array; the range found is all its verbatim matches with
their places.  Suffixes whose first words (three, or a shorter item's
all) begin no test suffix are left out of the sort, as no match can start
there: a bit table of those word groups decides that for whole arrays.

The benchmark goes to the executors in parts of a bounded number of bytes
(``part_bytes``), one after another.  With several parts each pass writes the
hits of the documents that have some, by the names of their rows; at the end
these documents, and no others, are joined to their hits (see ``verdicts``).

Defined results: null text has no words; a document without words is not
contaminated; items without words match nothing, a null ``item_id`` counts
as the empty string, and rows that repeat an ``item_id`` are one item;
rows that repeat a ``doc_id`` each get their own result; empty tables give
empty results or no hits; columns of ``docs`` that clash with the added
ones are replaced.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.llm.common import binary_list, lower_ascii, own_names, read_with, store
from agora.llm.verdicts import maybe_in, named_rows

#: Bytes that separate words, after A-Z became a-z; all others are kept.
_WORD_BYTE = [i >= 0x80 or 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A for i in range(256)]
_CLEAN = bytes((i + 32 if 0x41 <= i <= 0x5A else i) if 0x41 <= i <= 0x5A or _WORD_BYTE[i] else 32 for i in range(256))
LEAD = 3
TABLE_BITS = 22
SHARD_WORDS = 1 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HIT = "array<struct<start:long,end:long>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def _mixed(*ids: np.ndarray) -> np.ndarray:
    """A slot of the bit table for each group of word numbers."""
    h = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        h = (h + x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - TABLE_BITS)


def _rows(ids: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """The first ``window`` words from each start as strings of bytes that
    sort like the words; 0 ends a text."""
    at = np.minimum(starts[:, None] + np.arange(window), len(ids) - 1)
    rows = ids[at]
    ended = np.maximum.accumulate(rows == 0, axis=1)
    return np.where(ended, 0, rows).astype(">u4").view(f"S{4 * window}").ravel()


class Tests:
    """The test suffixes of one part of the benchmark: distinct windows,
    the items each occurs in, and the tables to find them by."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window, self.vocabulary, found = window, {}, {}
        for item, text in items:
            words = words_of(text)
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(ids[i:i + window], set()).add(item)
        keys = sorted(found)
        self.items = [sorted(found[k]) for k in keys]
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.low = self._keys(keys, b"\0")
        self.high = self._keys(keys, b"\xff")
        self.tables = {}
        for lead in range(1, min(LEAD, window) + 1):
            groups = [k[:lead] for k in keys if min(len(k), LEAD) == lead]
            if groups:
                self.tables[lead] = np.zeros(1 << TABLE_BITS, bool)
                self.tables[lead][_mixed(*np.array(groups, np.uint32).T)] = True

    def _keys(self, keys, pad: bytes) -> np.ndarray:
        size = 4 * self.window
        return np.array([np.array(k, ">u4").tobytes().ljust(size, pad) for k in keys], f"S{size}")

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All matches in one shard: places and test windows."""
        none = np.zeros(0, np.int64)
        if not len(self.items) or not len(ids):
            return none, none
        ends = np.concatenate([ids, np.zeros(LEAD, ids.dtype)])
        can = np.zeros(len(ids), bool)
        for lead, table in self.tables.items():
            can |= table[_mixed(*[ends[i:len(ids) + i] for i in range(lead)])]
        starts = np.flatnonzero(can & (ids != 0))
        suffixes = _rows(ends, starts, self.window)
        order = np.argsort(suffixes, kind="stable")
        array, places = suffixes[order], starts[order]
        lo, hi = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        count = hi - lo
        test = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(test)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        return places[at], test


def _shard(texts: list[bytes], tests: Tests):
    """Per document of a shard: number of words, hit spans, items."""
    lookup, lists = tests.vocabulary.get, [words_of(t) for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1  # a 0 between documents
    ids = np.zeros(int(sizes.sum()) + len(sizes), np.uint32)
    for b, words in zip(begin, lists):
        ids[b:b + len(words)] = np.fromiter((lookup(w, 0) for w in words), np.uint32, len(words))
    place, test = tests.search(ids)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.lengths[test], -1)
    flips = np.diff(np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]]))
    first, last = np.flatnonzero(flips == 1), np.flatnonzero(flips == -1)
    span_doc, test_doc = np.searchsorted(begin, first, "right") - 1, np.searchsorted(begin, place, "right") - 1
    spans, items = [[] for _ in texts], [set() for _ in texts]
    for d, a, b in zip(span_doc, first, last):
        spans[d].append({"start": int(a - begin[d]), "end": int(b - begin[d])})
    for d, t in set(zip(test_doc.tolist(), test.tolist())):
        items[d].update(tests.items[t])
    return sizes.tolist(), spans, [sorted(x) for x in items]


def _pass(docs: DataFrame, part, added: T.StructType) -> DataFrame:
    """One part of the benchmark over all documents."""
    schema = T.StructType(docs.schema.fields + added.fields)

    def run(batches):
        tests = part.value
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            texts = [t or b"" for t in binary_list(rows, "text")]
            n_words, hits, items, at = [], [], [], 0
            while at < len(texts):  # a shard: documents of so many bytes
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= 6 * SHARD_WORDS):
                    size, to = size + len(texts[to]), to + 1
                for out, new in zip((n_words, hits, items), _shard(texts[at:to], tests)):
                    out.extend(new)
                at = to
            kinds = (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()))
            for name, values, kind in zip(added.names, (n_words, hits, items), kinds):
                rows = rows.append_column(name, pa.array(values, kind))
            yield from rows.to_batches()

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                       part_bytes: int = 2 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (spans of word positions inside
    occurrences of a benchmark window; spans of several parts may overlap)
    and ``items`` (ids of the items with such windows)."""
    spark = docs.sparkSession
    added = T.StructType.fromDDL(f"n_words long, hits {HIT}, items array<string>")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-2 * total // part_bytes))
    docs = read_with(docs, added.names)

    def tests(p: int):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p).collect()  # about half of part_bytes
        return spark.sparkContext.broadcast(Tests([(r["item"], r["text"].encode()) for r in own], window))

    if parts == 1:
        return _pass(docs, tests(0), added)
    rows = named_rows(docs)
    texts, found = rows.select("row", "doc.text"), []
    for p in range(parts):
        found.append(store(_pass(texts, tests(p), added).where(F.size("hits") > 0).select("row", "hits", "items"), "hits"))
    hits = store(reduce(DataFrame.unionByName, found).groupBy(F.col("row").alias("of")).agg(  # a row has one from each part at most
        F.flatten(F.collect_list("hits")).alias("hits"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")), "all-hits")
    rows = maybe_in(rows, F.xxhash64("row"), hits.select(F.xxhash64("of").alias("h")), "some")
    n_words = F.regexp_count(lower_ascii(F.coalesce("doc.text", F.lit(""))), F.lit(WORD)).cast("long").alias("n_words")
    none = {f.name: F.array().cast(f.dataType) for f in added.fields[1:]}
    clean = rows.where("not some").select("doc.*", n_words, *[c.alias(n) for n, c in none.items()])
    hit = rows.where("some").join(hits, F.col("row") == F.col("of"), "left") \
        .select("doc.*", n_words, *[F.coalesce(n, c).alias(n) for n, c in none.items()])
    return clean.unionByName(hit)


def hit_words(hits) -> F.Column:
    """Words inside any span of ``hits``."""
    ordered = F.array_sort(hits)
    step = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda s, h: F.struct((s["n"] + F.greatest(h["end"] - F.greatest(h["start"], s["upto"]), F.lit(0))).alias("n"),
                              F.greatest(s["upto"], h["end"]).alias("upto")))
    return step["n"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    plain, back = own_names(docs)
    return back(find_contamination(plain, benchmark, window).where(F.size("hits") == 0))
