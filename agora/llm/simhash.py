"""SimHash near-dedup with bit-sliced comparison.

Every document gets a 64-bit fingerprint: a bit is set if it is set in
over half of the XXH64 hashes of its word shingles.  Fingerprints within
``radius`` bits link.  With the 64 bits cut into ``radius + 3`` parts, two
linked fingerprints agree on three parts at least, so distinct
fingerprints meet in one bucket for each choice of three parts.  Inside
the sorted buckets they are compared bit-sliced: 64 fingerprints make a
block of 64 bit planes, vertical carry-save counters hold the distances
of 64 queries to all of them, and a block goes as soon as all its
distances exceed the radius.  A bucket sends on a spanning star per
group, never all its pairs.

Scale: copies collapse to one fingerprint before anything meets; a bucket
shares about 38 bits, so it stays small at any corpus size.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; a component of null ids only
has a null ``component_id``; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import binary_list, store
from agora.llm.components import connected_components
from agora.llm.verdicts import named_rows, without

SEED = 42
LANES = 64
TILES = 512


def fingerprint(text: bytes, shingle_words: int) -> int:
    import xxhash

    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[k:])], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) and the long columns ``also``."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in binary_list(batch, "text")], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps.view("<i8")), *(batch[c] for c in also)],
                                             ["doc_id", "fp", *also])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *also)
    return read.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *also)))


# ---- bit-sliced comparison ---------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """[blocks, 64] words: bit ``i`` of word ``j`` of a block is bit ``j``
    of its fingerprint ``i``."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, LANES, 8), axis=2, bitorder="little")
    packed = np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little"))
    return packed.view("<u8").reshape(-1, 64)


def within_radius(queries: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """queries, planes: [tiles, 64].  Returns the tiles that still have a
    near lane and, for each of their queries, the lanes within ``radius``."""
    alive = np.arange(len(queries))
    counters = [np.zeros((len(queries), LANES), np.uint64) for _ in range(radius.bit_length())]
    beyond = np.zeros((len(queries), LANES), np.uint64)
    far = beyond
    for j in range(64):
        bit = (queries >> np.uint64(j)) & np.uint64(1)
        carry = planes[:, j, None] ^ (np.uint64(0) - bit)
        for c in counters:  # carry-save: add one differing bit per lane
            carry, c[...] = c & carry, c ^ carry
        beyond |= carry
        if j % 8 == 7:
            over, level = beyond, np.full_like(beyond, ~np.uint64(0))
            for i in reversed(range(len(counters))):
                if radius >> i & 1:
                    level = level & counters[i]
                else:
                    over, level = over | (level & counters[i]), level & ~counters[i]
            far = over
            keep = (far != ~np.uint64(0)).any(axis=1)
            if not keep.all():  # every distance of the tile exceeds the radius
                alive, queries, planes, beyond, far = alive[keep], queries[keep], planes[keep], beyond[keep], far[keep]
                counters = [c[keep] for c in counters]
            if not len(alive):
                break
    return alive, ~far


def _root(label: np.ndarray, i: np.ndarray) -> np.ndarray:
    r = label[i]
    while True:
        up = label[r]
        if (up == r).all():
            return r
        r = up


def near_stars(fps: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """Rows (fingerprint, smaller index's fingerprint) that join what is
    within ``radius`` in one bucket.  ``bucket`` is sorted."""
    n = len(fps)
    blocks = -(-n // LANES)
    padded = np.concatenate([fps, np.repeat(fps[-1:], blocks * LANES - n)])
    rows, planes = padded.reshape(blocks, LANES), bit_planes(padded)
    last = np.minimum(np.arange(1, blocks + 1) * LANES, n) - 1
    reach = (np.searchsorted(bucket, bucket[last], "right") - 1) // LANES  # last block that a block must meet
    label = np.arange(n)
    count = reach - np.arange(blocks) + 1
    ends = np.cumsum(count)
    for at in range(0, int(ends[-1]), TILES):
        t = np.arange(at, min(at + TILES, int(ends[-1])))
        a = np.searchsorted(ends, t, "right")
        b = a + t - (ends[a] - count[a])
        alive, near = within_radius(rows[a], planes[b], radius)
        tile, query, lane = np.nonzero(np.unpackbits(
            near.astype("<u8").view(np.uint8).reshape(-1, LANES, 8), axis=2, bitorder="little"))
        i, j = a[alive[tile]] * LANES + query, b[alive[tile]] * LANES + lane
        ok = (i < j) & (j < n)
        i, j = i[ok], j[ok]
        while len(i):
            i, j = _root(label, i), _root(label, j)
            open_ = i != j
            i, j = i[open_], j[open_]
            np.minimum.at(label, np.maximum(i, j), np.minimum(i, j))
    root = _root(label, np.arange(n))
    moved = np.flatnonzero(root != np.arange(n))
    return np.stack([fps[moved], fps[root[moved]]])


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """``fp`` (distinct) to ``u, v``: links that join all fingerprints
    within ``radius`` of one another, through as few rows as that takes."""
    parts = radius + 3
    edges = [64 * i // parts for i in range(parts + 1)]
    masks = []
    for chosen in combinations(range(parts), 3):
        m = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for t, m in enumerate(masks)])
    spread = distinct.select("fp", F.inline(keys)).repartition("t", "key").sortWithinPartitions("t", "key", "fp")

    def run(batches):
        held = None
        for batch in batches:
            t, key, fp = (batch[c].to_numpy(zero_copy_only=False) for c in ("t", "key", "fp"))
            part = (t, key, fp) if held is None else tuple(map(np.concatenate, zip(held, (t, key, fp))))
            new = np.flatnonzero((part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])) + 1
            cut = new[-1] if len(new) else 0  # the last bucket may go on
            held = tuple(x[cut:] for x in part)
            yield from compare(*(x[:cut] for x in part))
        if held is not None:
            yield from compare(*held)

    def compare(t, key, fp):
        if len(fp) < 2:
            return
        start = np.concatenate([[True], (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
        bucket = np.cumsum(start)
        shared = np.bincount(bucket)[bucket] > 1
        if shared.any():
            out = near_stars(fp[shared].view(np.uint64), bucket[shared], radius).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["u", "v"])

    return spread.mapInArrow(run, "u long, v long").distinct()


def rooted(first: DataFrame, radius: int) -> DataFrame:
    """``first`` (one row per ``fp``) with the ``root`` of its component."""
    roots = connected_components(near_links(first.select("fp"), radius))
    return first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_dedup(docs: DataFrame, shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (smallest ``doc_id`` reachable over links)."""
    fps = store(fingerprints(docs, shingle_words), "fingerprints")
    member = rooted(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), radius)
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(member.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = 3, radius: int = 2, judge_null_ids: bool = False) -> DataFrame:
    """One row of each component stays, with its own columns: the one with
    the smallest ``doc_id``, then fingerprint, then place in the files, so
    that an id repeated with one text or several is judged row by row.  Rows
    without an id stay beside it, or with ``judge_null_ids`` come last in it.
    Fingerprints travel, texts only for what the bitmap of the rows lost
    can't tell apart from them."""
    rows = named_rows(docs)
    fps = store(fingerprints(rows.select("doc.doc_id", "doc.text", "row.file", "row.place"), shingle_words, ("file", "place")),
                "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "file", "place")
    member = rooted(fps.groupBy("fp").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")), radius)
    least = member.groupBy("root").agg(F.min("first").alias("stays"), F.sum("n").alias("all")).where(F.col("all") > 1)
    lost = fps.join(member.join(least, "root").select("fp", "stays"), "fp") \
        .where((F.col("file") != F.col("stays.file")) | (F.col("place") != F.col("stays.place")))
    if not judge_null_ids:
        lost = lost.where("doc_id is not null")
    lost = store(lost.select(F.struct("file", "place").alias("lost")), "near-copies")
    return without(rows, lost)
