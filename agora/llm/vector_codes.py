"""Compression of vectors into codes: one entry of a codebook per part.

Components become integers, vectors are cut into equal parts, and each part
position has a codebook that rounds of nearest-entry assignment and
averaging refine, all in exact integers.  Assignments after the first are
pruned by norm-of-sum bounds: for each group of codebook entries a row keeps
a lower bound on its distance to the group's entries (its own left out),
with the stamp of the round that the bound was measured in.  The codebooks
of all rounds are kept, so a bound measured in round ``s`` is lowered by the
largest *net* displacement of the group's entries from round ``s`` to now,
which is never more than the sum of their drifts round by round.  A group
whose bound still exceeds the exact distance to the row's own entry is not
looked at; the others are rescanned exactly and their bounds stamped anew.
The margins of the comparison cover the rounding of the square roots, so
codes and errors are those of a full scan, ties to the lower index.

Scale: rows carry their bounds along (5 bytes per group and part) in a table
of the shared folder, one per round, of which two exist at a time; nothing
is shuffled but per-task sums of ``parts x entries`` codebook cells.  What
goes to the driver and back are the codebooks, ``entries x width`` integers
a round.

Defined results: a row is dropped if its vector is null, holds null or
non-finite components, or has another length than that of the smallest
``vec_id`` kept; a length that ``parts`` doesn't divide is an error.
Integers are clamped to +-2^24, so that squared distances fit 64 bits.  A
null ``vec_id`` sorts last; rows that repeat one are ordered by their
vectors and each gets its code.  With fewer rows than ``entries`` the
codebooks are as short; an empty table gives an empty result.  Columns other
than the id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import store_at
from agora.operators.keys import in_scratch, remove

LIMIT = 1 << 24
ROWS = 4096
FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class VectorCodes:
    """``rows``: ``vec_id, label, code`` (one byte per part)``, error, held``
    (bounds that spared a scan of their group); ``codebooks``: [part, entry, position]."""
    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """``vec_id, label, ints`` of the rows whose vectors are whole and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    ints = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)),
                                                    F.lit(-LIMIT)).cast("int"))
    return vectors.where(F.col(vector).isNotNull() & finite).select("vec_id", "label", ints.alias("ints"))


# ---- one part position -------------------------------------------------

def group_starts(entries: int, groups: int) -> np.ndarray:
    return np.arange(0, entries, -(-entries // groups))


def net_displacements(books: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """[stamp, group]: how far the farthest entry of a group lies now from
    where it lay in the round of the stamp."""
    moved = np.sqrt(((books - books[-1]) ** 2).sum(axis=2).astype(np.float64))
    return np.maximum.reduceat(moved, starts, axis=1)


def assign(x: np.ndarray, books: np.ndarray, starts: np.ndarray, entry=None, low=None, stamp=None):
    """Nearest entries of the last of ``books`` [round, entry, position] for
    the rows ``x``, given the bounds of earlier rounds (none: a full scan).
    Returns entries, squared distances, bounds, stamps and how many bounds held."""
    now, at, t = books[-1], np.arange(len(x)), len(books) - 1
    ends = np.append(starts[1:], len(now))
    if entry is None:
        scan = np.ones((len(x), len(starts)), bool)
    else:
        own = ((x - now[entry]) ** 2).sum(axis=1)
        reach = low - net_displacements(books, starts)[stamp, np.arange(len(starts))]
        scan = reach <= np.sqrt(own)[:, None] * (1 + 1e-9) + 1e-6
    distance = np.full((len(x), len(now)), FAR)
    for g, (a, b) in enumerate(zip(starts, ends)):
        rows = np.flatnonzero(scan[:, g])
        distance[rows, a:b] = ((x[rows, None, :] - now[a:b]) ** 2).sum(axis=2)
    if entry is not None:
        distance[at, entry] = own
    best = distance.argmin(axis=1)
    error = distance[at, best].copy()
    distance[at, best] = FAR
    rival = np.sqrt(np.minimum.reduceat(distance, starts, axis=1).astype(np.float64))
    if entry is None:
        new_low, new_stamp = rival, np.zeros(scan.shape, np.uint8)
    else:
        new_low, new_stamp = np.where(scan, rival, low), np.where(scan, t, stamp)
        home = np.searchsorted(starts, entry, "right") - 1
        left = np.flatnonzero((best != entry) & ~scan[at, home])  # the entry left is now among its group's others
        new_low[left, home[left]] = np.minimum(reach[left, home[left]], np.sqrt(own[left]))
        new_stamp[left, home[left]] = t
    return best, error, np.nextafter(new_low.astype(np.float32), np.float32(-np.inf)), new_stamp, int((~scan).sum())


# ---- rounds ------------------------------------------------------------

def _bytes(column, kind, shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(shape)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _ints(batch, parts: int) -> np.ndarray:
    return batch["ints"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), parts, -1)


def _assigned(rows: DataFrame, history: list[np.ndarray], groups: int, last: bool) -> DataFrame:
    """One assignment of all rows; the last one gives errors, not bounds."""
    books = np.stack(history)  # [round, part, entry, position]
    parts = books.shape[1]
    starts = group_starts(books.shape[2], groups)
    first = len(history) == 1
    width = len(starts)

    def run(batches):
        for whole in batches:
            for i in range(0, len(whole), ROWS):
                batch = whole.slice(i, ROWS)
                x, n = _ints(batch, parts), len(batch)
                if not first:
                    code = _bytes(batch["code"], np.uint8, (n, parts))
                    low = _bytes(batch["low"], np.float32, (n, parts, width))
                    stamp = _bytes(batch["stamp"], np.uint8, (n, parts, width))
                out = [assign(x[:, p], books[:, p], starts, *(() if first else (code[:, p], low[:, p], stamp[:, p])))
                       for p in range(parts)]
                made = [batch["vec_id"], batch["label"], _binary(np.stack([o[0] for o in out], 1).astype(np.uint8))]
                if last:
                    held = pa.array(np.full(n, sum(o[4] for o in out) // max(n, 1)))
                    made += [pa.array(np.stack([o[1] for o in out], 1).sum(axis=1)), held]
                else:
                    made += [batch["ints"], _binary(np.stack([o[2] for o in out], 1)),
                             _binary(np.stack([o[3] for o in out], 1).astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(made, names)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    kinds |= {"code": "binary", "low": "binary", "stamp": "binary", "error": "long", "held": "long"}
    names = ["vec_id", "label", "code", *(("error", "held") if last else ("ints", "low", "stamp"))]
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))


def _averaged(rows: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook whose entries are the floored means of their rows' parts."""
    shape = book.shape

    def run(batches):
        total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            x, code = _ints(batch, shape[0]), _bytes(batch["code"], np.uint8, (len(batch), shape[0]))
            for p in range(shape[0]):
                np.add.at(total[p], code[:, p], x[:, p])
                np.add.at(count[p], code[:, p], 1)
        used = np.repeat(count.ravel() > 0, shape[2])
        cell = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell]),
                                          pa.array(np.repeat(count.ravel(), shape[2])[cell])], ["cell", "total", "n"])

    cells = rows.select("ints", "code").mapInArrow(run, "cell long, total long, n long") \
        .groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    new = book.ravel().copy()
    for c in cells:
        new[c["cell"]] = c["total"] // c["n"]
    return new.reshape(shape)


def compress_vectors(vectors: DataFrame, vector: str = "embedding", parts: int = 16, entries: int = 64,
                     rounds: int = 2, scale: int = 256, groups: int = 8) -> VectorCodes:
    """Codes of all whole vectors by ``parts`` codebooks of ``entries``
    (256 at most), refined in ``rounds`` (255 at most)."""
    if not (1 <= entries <= 256 and 0 <= rounds <= 255):
        raise ValueError("entries must be in 1..256 and rounds in 0..255")
    spark = vectors.sparkSession
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    kept, path = store_at(integer_vectors(vectors, vector, scale), "vectors")
    head = kept.orderBy(*order).select(F.size("ints").alias("n")).first()
    length = head["n"] if head else parts
    if length % parts:
        raise ValueError(f"{parts} equal parts can't be cut from vectors of length {length}")
    rows = kept.where(F.size("ints") == length)
    seed = np.array([r["ints"] for r in rows.orderBy(*order).limit(entries).collect()], np.int64)
    history = [seed.reshape(len(seed), parts, length // parts).transpose(1, 0, 2).copy()]
    if not len(seed):
        in_scratch(path)
        return VectorCodes(rows.selectExpr("vec_id", "label", "cast(null as binary) code", "0L error", "0L held"), history[0])
    for _ in range(rounds):
        rows, now = store_at(_assigned(rows, history, groups, last=False), "vector-bounds")
        remove(spark, path)
        path = now
        history.append(_averaged(rows, history[-1]))
    in_scratch(path)  # the result still reads it
    return VectorCodes(_assigned(rows, history, groups, last=True), history[-1])
