"""Ranked lexical search: block-max MaxScore over an inverted index in shards.

A shard is a bounded run of documents, indexed in the task that reads them:
one row per term with its postings, cut into blocks of ``BLOCK`` documents
and compressed to two bytes a posting.  Beside each block stand the pairs
(occurrences, length) that no other posting of the block beats in both, so
the exact maximum of the block's scores is known from them without
decompression, whatever the corpus statistics come to be.

A search sums the shards' counts for its terms and then goes through the
shards, carrying each query's best documents along.  Terms are ordered by
the maximum they can add in the shard; those whose sum stays below the
``k``-th best score are non-essential.  Only essential lists are read in
turn, in windows of documents.  A candidate found there must still beat the
``k``-th best score with the block maxima of the non-essential lists added;
the rest is rejected before any of those is decompressed, and survivors are
checked again as one list after the other joins in.  What the tasks return,
``k`` rows a query each, is merged by score and ``doc_id``.

Scale: documents are never shuffled, and the index only its rows for terms
of the queries, dealt by shard; shards are of one size, so neither a
frequent term nor a group of copies is hot.  Queries go to the executors in
parts of at most ``part_bytes`` of text, each one pass over those rows that
writes nothing but its best documents.  The statistics sent back are one
number per term of a part.

Defined results: null text has no terms; a document or item without terms
is in no result; equal scores are ordered by ascending ``doc_id``, null
last; rows that repeat a ``doc_id`` rank as documents of their own; rows that
repeat an ``item_id`` and text are one item, those with other texts under the
same id are ranked each; other columns are not read; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import store

BLOCK = 64
WINDOW = 16  # blocks
INDEX = ("shard long, term string, df int, blocks array<int>, counts array<int>, places binary, times binary, "
         "often array<int>, front array<int>, front_times array<int>, front_words array<int>, ids array<long>, words array<int>")
HITS = "item int, doc_id long, score long"

#: Bytes of terms; everything else separates them.
_IN_TERM = np.array([i >= 0x80 or 0x30 <= i <= 0x39 or 0x41 <= i <= 0x5A or 0x61 <= i <= 0x7A for i in range(256)])
_LOWER = np.array([i + 32 if 0x41 <= i <= 0x5A else i for i in range(256)], np.uint8)
_CLEAN = bytes(int(_LOWER[i]) if _IN_TERM[i] else 32 for i in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


# ---- building ----------------------------------------------------------

def _lists(kind, offsets, values) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _blobs(offsets, values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.asarray(offsets, np.int32)), pa.py_buffer(values)])


def _ends(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _occurrences(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts and the text that each stands in."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = _IN_TERM[raw]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begin = _ends([len(t) + 1 for t in texts])
    packed = pa.py_buffer(np.ascontiguousarray(_LOWER[raw[inside]]))
    offsets = pa.py_buffer(_ends(last - first))
    terms = pa.Array.from_buffers(pa.large_binary(), len(first), [None, offsets, packed])
    return terms, np.searchsorted(begin, first, "right") - 1


def index_shard(shard: int, ids: list, texts: list[bytes]) -> list[pa.RecordBatch]:
    """The index rows of one shard; the first one, without a term, has its documents."""
    terms, doc = _occurrences(texts)
    words = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    coded = terms.dictionary_encode()
    pair, times = np.unique(coded.indices.to_numpy().astype(np.int64) * len(texts) + doc, return_counts=True)
    term, place = pair // len(texts), pair % len(texts)
    block = place // BLOCK
    n = len(coded.dictionary)
    starts = np.flatnonzero(np.diff(term * len(texts) + block, prepend=-1))  # a block of a list begins
    of_block = np.cumsum(np.bincount(starts, minlength=len(term))) - 1
    # what no posting of its block beats: most occurrences first, then ever shorter documents
    order = np.lexsort((words[place], -times, of_block))
    shortest = np.minimum.accumulate(words[place[order]] - (of_block[order] << 32))
    front = order[np.flatnonzero(np.diff(shortest, prepend=1 << 62))]
    often = times >= 255
    per_term = np.bincount(term, minlength=n)
    made = {
        "shard": pa.array(np.full(n, shard)), "term": coded.dictionary.cast(pa.binary()).cast(pa.string()),
        "df": pa.array(per_term.astype(np.int32)),
        "blocks": _lists(pa.int32(), _ends(np.bincount(term[starts], minlength=n)), block[starts]),
        "counts": _lists(pa.int32(), _ends(np.bincount(term[starts], minlength=n)), np.diff(np.append(starts, len(term)))),
        "places": _blobs(_ends(per_term), (place % BLOCK).astype(np.uint8)),
        "times": _blobs(_ends(per_term), np.minimum(times, 255).astype(np.uint8)),
        "often": _lists(pa.int32(), _ends(np.bincount(term[often], minlength=n)), times[often]),
        "front": _lists(pa.int32(), _ends(np.bincount(term[starts], minlength=n)), np.bincount(of_block[front], minlength=len(starts))),
        "front_times": _lists(pa.int32(), _ends(np.bincount(term[front], minlength=n)), times[front]),
        "front_words": _lists(pa.int32(), _ends(np.bincount(term[front], minlength=n)), words[place[front]]),
        "ids": pa.nulls(n, pa.list_(pa.int64())), "words": pa.nulls(n, pa.list_(pa.int32()))}
    rows = pa.RecordBatch.from_pydict(made)
    own = {"shard": [shard], "ids": [ids], "words": [words.tolist()]}
    head = pa.RecordBatch.from_arrays([pa.array(own.get(f.name, [None]), f.type) for f in rows.schema], schema=rows.schema)
    return [head, rows]


def build_index(docs: DataFrame, shard_bytes: int = 8 << 20) -> DataFrame:
    """The index of all documents; a shard holds about ``shard_bytes`` of text."""
    def run(batches):
        shard, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= shard_bytes or len(ids) >= 1 << 16:
                    yield from index_shard(shard, ids, texts)
                    shard, ids, texts, size = shard + 1, [], [], 0
        if ids:
            yield from index_shard(shard, ids, texts)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(run, INDEX)


# ---- searching ---------------------------------------------------------

class Statistics:
    """What scores depend on: number of documents and of all their terms."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def length(self, words: np.ndarray) -> np.ndarray:
        """A document's ``m``, in 64 bits unless that could overflow."""
        if len(words) and 75 * int(words.max()) * self.documents >= 1 << 62:
            return np.array([25 + 75 * int(w) * self.documents // self.terms for w in words], np.int64)
        return 25 + 75 * words * self.documents // max(self.terms, 1)


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 8 * m)


class Shard:
    """One shard's lists for the terms asked, as they come: compressed."""

    def __init__(self, rows: pa.Table, stats: Statistics):
        rows = rows.combine_chunks()
        head = rows.filter(pa.compute.is_null(rows["term"])).to_pylist()[0]
        self.ids, self.m = head["ids"], stats.length(np.array(head["words"], np.int64))
        self.blocks = -(-len(self.ids) // BLOCK)
        rows = rows.filter(pa.compute.is_valid(rows["term"]))
        flat = {c: rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(rows) else np.zeros(0, np.int32)
                for c in ("blocks", "counts", "often", "front", "front_times", "front_words")}
        self.block, self.end = flat["blocks"].astype(np.int64), _ends(flat["counts"])
        self.often = flat["often"].astype(np.int64)
        self.places, self.times = (np.frombuffer(b"".join(rows[c].to_pylist()), np.uint8) for c in ("places", "times"))
        size = pa.compute.list_value_length(rows["blocks"]).to_numpy()
        self.at = dict(zip(rows["term"].to_pylist(), zip(_ends(size)[:-1], _ends(size)[1:], strict=True), strict=True))
        found = impact(flat["front_times"].astype(np.int64), stats.length(flat["front_words"].astype(np.int64)))
        self.most = np.maximum.reduceat(found, _ends(flat["front"])[:-1]) if len(found) else found
        self.decompressed = 0

    def maxima(self, term: str) -> np.ndarray:
        """The largest impact in each block of the shard."""
        out = np.zeros(self.blocks, np.int64)
        a, b = self.at[term]
        out[self.block[a:b]] = self.most[a:b]
        return out

    def postings(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the blocks ``a`` to ``b`` of all lists' blocks."""
        i, j = self.end[a], self.end[b]
        self.decompressed += b - a
        place = np.repeat(self.block[a:b] * BLOCK, self.end[a + 1:b + 1] - self.end[a:b]) + self.places[i:j]
        times = self.times[i:j].astype(np.int64)
        full = np.flatnonzero(times == 255)
        if len(full):
            times[full] = self.often[np.count_nonzero(self.times[:i] == 255) + np.arange(len(full))]
        return place, impact(times, self.m[place])


class Best:
    """The ``k`` best documents so far, by score, then ``doc_id`` (null last)."""

    def __init__(self, k: int):
        self.k, self.found, self.bar = k, [], 0

    def add(self, scores, ids) -> None:
        new = [(-s, i is None, i or 0) for s, i in zip(scores, ids)]
        self.found = sorted(self.found + new)[:self.k]
        self.bar = -self.found[-1][0] if len(self.found) == self.k else 0


def search(shard: Shard, query: list[tuple[str, int]], best: Best) -> None:
    """``query``: terms with their weight times their repeats in the item."""
    query = [(t, w) for t, w in query if t in shard.at and w]
    if not query:
        return
    most = np.stack([w * shard.maxima(t) for t, w in query])
    order = np.argsort(most.max(axis=1), kind="stable")
    most, query = most[order], [query[i] for i in order]
    below = np.cumsum(most.max(axis=1))
    spans = [shard.at[t] for t, _ in query]
    for w0 in range(0, shard.blocks, WINDOW):
        w1 = min(w0 + WINDOW, shard.blocks)
        rest = int(np.searchsorted(below, best.bar, "left"))  # these lists alone stay below the bar
        if rest == len(query):
            return
        if int(most[:, w0:w1].sum(axis=0).max()) < best.bar:
            continue
        score = np.zeros((w1 - w0) * BLOCK, np.int64)

        def read(i: int, lo: int, hi: int) -> None:
            a, b = spans[i]
            a, b = a + np.searchsorted(shard.block[a:b], [lo, hi])
            if a < b:
                place, found = shard.postings(a, b)
                score[place - w0 * BLOCK] += query[i][1] * found

        for i in range(rest, len(query)):
            read(i, w0, w1)
        more = most[:rest, w0:w1].sum(axis=0)
        c = np.flatnonzero(score)
        c = c[score[c] + more[c // BLOCK] >= best.bar]
        for i in reversed(range(rest)):
            if not len(c):
                break
            more = more - most[i, w0:w1]
            for b in np.unique(c // BLOCK):
                if most[i, w0 + b]:
                    read(i, w0 + b, w0 + b + 1)
            c = c[score[c] + more[c // BLOCK] >= best.bar]
        if len(c):
            best.add(score[c].tolist(), [shard.ids[w0 * BLOCK + p] for p in c.tolist()])


def _searched(rows: DataFrame, part, k: int) -> DataFrame:
    """The best documents of each task's shards, for each query of a part."""
    def run(batches):
        stats, queries = part.value
        best, held = [Best(k) for _ in queries], []

        def visit(shard_rows):
            shard = Shard(pa.Table.from_batches(shard_rows), stats)
            for (_, terms), b in zip(queries, best):
                search(shard, terms, b)

        for batch in batches:
            shards = batch["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if held and held[0]["shard"][0].as_py() != shards[a]:
                        visit(held)
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            visit(held)
        out = [(item, None if none else i, -s) for (item, _), b in zip(queries, best) for s, none, i in b.found]
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(("item", "doc_id", "score"), map(list, zip(*out)))),
                                             pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return rows.repartition("shard").sortWithinPartitions("shard", F.col("term").isNotNull()).mapInArrow(run, HITS)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, part_bytes: int = 1 << 20,
                  shard_bytes: int = 8 << 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents."""
    spark = docs.sparkSession
    index = store(build_index(docs, shard_bytes), "index")
    words = index.where("term is null").select(
        F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w).alias("all"), F.size(F.filter("words", lambda w: w > 0)).alias("some"))
    found = words.agg(F.sum("some"), F.sum("all")).first()
    stats = Statistics(found[0] or 0, found[1] or 0)
    texts = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-2 * total // part_bytes))
    out = []
    for p in range(parts):
        own = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).collect()  # about half of part_bytes
        counts = [Counter(t.decode() for t in terms_of(r["text"].encode())) for r in own]
        names = spark.createDataFrame([(t,) for t in sorted(set().union(*counts))], "name string")
        if sum(len(r["text"]) for r in own) <= part_bytes:  # so the terms of a part fit every executor
            names = F.broadcast(names)
        of = index.where("term is not null").join(names, F.col("term") == F.col("name"), "left_semi")
        df = {r["term"]: r["df"] for r in of.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weight = {t: stats.weight(n) for t, n in df.items()}
        queries = [(i, [(t, n * weight[t]) for t, n in sorted(c.items()) if t in weight]) for i, c in enumerate(counts)]
        sent = spark.sparkContext.broadcast((stats, queries))
        hits = _searched(of.unionByName(index.where("term is null")), sent, k)
        known = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(ranked.join(known, "item").select("item_id", "rank", "doc_id", "score"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
