"""Repeated windows of a corpus: what substring and suffix-array dedup share.

A window is ``window`` consecutive units (words or bytes) of one document.
A unit is removed if a window over it also starts earlier in the corpus
(smaller ``doc_id``, or same document and earlier start).  Three steps,
none of which sees the whole corpus in one task:

1. *Anchors.*  The smallest hash among a window's k-grams is its anchor;
   equal windows have equal anchors.  Runs of windows with one anchor are
   counted per block of documents and summed over the corpus; only anchors
   that occur twice can belong to a repeated window, so the rest of the
   corpus is settled.  This is exact: nothing repeated is passed over.
2. *Shards.*  The text under each run with a repeated anchor goes to the
   anchor's shard, once per block and text (later copies inside a block
   are repeats at once).  All occurrences of a window thus meet in one
   shard, where the operator's own index judges which start earlier.  An
   anchor with ``hot`` runs or more is split: its windows go one by one to
   the shard of their own hash.  Rows stream through a shard's task in
   order: copies of a text are settled as they pass, so what a task holds
   is the distinct texts of one anchor, fewer than ``hot``.
3. *Removal.*  The spans found go back to the document's block.

The blocks are one shuffle of the documents, read by all three steps.

Rows are ordered by ``doc_id`` (null last), block, and place in the block;
of rows that repeat a ``doc_id``, the later one in that order is later.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import binary_list, sorted_block, text_blocks

LAST = np.iinfo(np.int64).max
#: Documents of a block, in bytes of text; runs that make an anchor hot.
BLOCK_BYTES, HOT_RUNS = 8 << 20, 30_000


def scattered(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Units(ABC):
    """How one operator cuts texts, and how it judges a shard."""

    window: int
    gram: int

    @abstractmethod
    def cut(self, text: bytes):
        """The units of a text; has a length."""

    @abstractmethod
    def grams(self, units) -> np.ndarray:
        """Hash of each ``gram`` consecutive units; at least that many units."""

    @abstractmethod
    def join(self, units, start: int, end: int) -> bytes:
        """The units start .. end-1 as one string, equal only for equal units."""

    @abstractmethod
    def kept(self, units, removed: np.ndarray | None) -> bytes:
        """The text without the removed units."""

    @abstractmethod
    def judge(self, groups: list[list[tuple[bytes, int]]]):
        """For each string of each group (in corpus order, with its number
        of windows) the unit spans under windows that start earlier: yields
        ``group, string, start, end``."""


class Runs:
    """Maximal runs of windows of one document that share an anchor."""

    def __init__(self, cutter: Units, units):
        n = len(units) - cutter.window + 1
        if n <= 0:
            self.first = self.end = np.zeros(0, np.int64)
            self.anchor, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        grams, width = cutter.grams(units), cutter.window - cutter.gram + 1
        least, have = grams, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        self.first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        self.end = np.append(self.first[1:], n)
        self.anchor = least[self.first]
        # the anchor's first and last place in the run: two places if windows of the run can be equal
        view = np.lib.stride_tricks.sliding_window_view(grams, width)
        left = self.first + (view[self.first] == self.anchor[:, None]).argmax(axis=1)
        right = self.end - 1 + width - 1 - (view[self.end - 1] == self.anchor[:, None])[:, ::-1].argmax(axis=1)
        self.again = left != right


def _spans_to(length: int, starts, ends) -> np.ndarray:
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, cutter: Units, block_bytes: int = BLOCK_BYTES, hot: int = HOT_RUNS) -> DataFrame:
    """One row per document: ``doc_id, n_units, n_removed, spans`` (removed,
    maximal) and ``kept`` (bytes)."""
    blocks = text_blocks(docs, block_bytes)

    def count(block):
        own, rows = [], sorted_block(block)
        for text in binary_list(rows, "text"):
            runs = Runs(cutter, cutter.cut(text))
            own += [runs.anchor, runs.anchor[runs.again]]
        anchors, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
        return pa.table({"anchor": pa.array(anchors.view(np.int64)), "block": pa.array(
            np.full(len(anchors), rows["block"][0].as_py(), np.int32)), "n": pa.array(n.astype(np.int64))})

    counted = blocks.groupBy("block").applyInArrow(count, "anchor long, block int, n long")
    repeated = counted.withColumn("runs", F.sum("n").over(Window.partitionBy("anchor"))).where("runs > 1") \
        .select(F.col("block"), "anchor", (F.col("runs") >= hot).alias("hot"))

    def gather(block, wanted):
        import xxhash

        if not block.num_rows or not wanted.num_rows:
            return _SENT.empty_table()
        anchors = wanted["anchor"].to_numpy().view(np.uint64)
        order = np.argsort(anchors)
        anchors, is_hot = anchors[order], wanted["hot"].to_numpy()[order]
        rows, seen, sent = sorted_block(block), set(), []
        number = rows["block"][0].as_py()
        for i, (doc, text) in enumerate(zip(rows["doc_id"].to_pylist(), binary_list(rows, "text"))):
            units = cutter.cut(text)
            runs, local = Runs(cutter, units), []
            at = np.minimum(np.searchsorted(anchors, runs.anchor), len(anchors) - 1)
            for r in np.flatnonzero(anchors[at] == runs.anchor).tolist():
                first, end, anchor = int(runs.first[r]), int(runs.end[r]), int(runs.anchor[r])
                pieces = [(first, end)] if not is_hot[at[r]] else [(s, s + 1) for s in range(first, end)]
                for a, b in pieces:
                    text_of = cutter.join(units, a, b + cutter.window - 1)
                    if text_of in seen:
                        local.append((a, b + cutter.window - 1))
                        continue
                    seen.add(text_of)
                    key = xxhash.xxh64_intdigest(text_of) if is_hot[at[r]] else anchor
                    sent.append((key - (1 << 64) if key >> 63 else key, text_of, LAST if doc is None else doc,
                                 number, i, a, b - a, bool(runs.again[r]) and b - a > 1))
            sent += [(hash((number, i, a)), None, 0, number, i, a, b, False) for a, b in merged(local)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*sent), _SENT)], schema=_SENT) \
            if sent else _SENT.empty_table()

    sent = blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        gather, "key long, part binary, doc long, block int, place int, start long, windows long, again boolean")
    sharded = sent.repartition("key").sortWithinPartitions("key", "part", "doc", "block", "place", "start")

    def judge(batches):
        before, held = None, []  # the last row with a text; distinct texts of keys not judged yet
        size = 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            key, part = rows["key"].to_numpy(), rows["part"].combine_chunks()
            known = ~part.is_null().to_numpy(zero_copy_only=False)
            same = np.zeros(len(key), bool)
            same[1:] = pc.fill_null(pc.equal(part[1:], part[:-1]), False).to_numpy(zero_copy_only=False) \
                & (key[1:] == key[:-1])
            if before is not None and len(key) and known[0]:
                same[0] = before == (key[0], part[0].as_py())
            if len(key) and known[-1]:
                before = (key[-1], part[-1].as_py())
            done = same | ~known  # copies of a text whose first place stands before them; spans already settled
            yield from settled(rows.filter(pa.array(done))).to_batches()
            first = rows.filter(pa.array(~done))
            if not first.num_rows:
                continue
            held.append(first)
            size += first.num_rows
            if size >= 1 << 15 and held[0]["key"][0] != first["key"][-1]:
                texts = pa.concat_tables(held)
                cut = int(np.searchsorted(texts["key"].to_numpy(), key[~done][-1]))  # the last key may go on
                yield from judged(texts.slice(0, cut).combine_chunks()).to_batches()
                held, size = [texts.slice(cut).combine_chunks()], texts.num_rows - cut
        if held:
            yield from judged(pa.concat_tables(held).combine_chunks()).to_batches()

    def settled(rows):
        start, windows = rows["start"].to_numpy(), rows["windows"].to_numpy()
        known = rows["part"].is_valid().to_numpy()
        end = np.where(known, start + windows + cutter.window - 1, windows)
        return pa.Table.from_arrays([rows["block"], rows["place"], rows["start"], pa.array(end)], schema=_SPAN)

    def judged(rows):
        """Spans of distinct texts, whole keys at a time."""
        key, part = rows["key"].to_numpy(), rows["part"].combine_chunks()
        start, windows = rows["start"].to_numpy(), rows["windows"].to_numpy()
        block, place, again = rows["block"].to_numpy(), rows["place"].to_numpy(), rows["again"].to_numpy()
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        own = (np.bincount(group) > 1) | (np.bincount(group, again) > 0)
        ask = np.flatnonzero(own[group])
        if not len(ask):
            return _SPAN.empty_table()
        ask = ask[np.lexsort((start[ask], place[ask], block[ask], rows["doc"].to_numpy()[ask], group[ask]))]
        bounds = np.flatnonzero(np.diff(group[ask], prepend=-1))
        texts = part.take(pa.array(ask)).to_pylist()
        groups = [list(zip(texts[a:b], windows[ask[a:b]].tolist()))
                  for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(ask)])]
        found = np.array([(ask[bounds[g] + t], a, b) for g, t, a, b in cutter.judge(groups)], np.int64).reshape(-1, 3)
        row, base = found[:, 0], start[found[:, 0]]
        columns = (block[row], place[row], base + found[:, 1], base + found[:, 2])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPAN)], schema=_SPAN)

    spans = sharded.mapInArrow(judge, "block int, place int, start long, end long")

    def strip(block, spans):
        rows = sorted_block(block)
        place = spans["place"].to_numpy()
        order = np.argsort(place, kind="stable")
        place, start, end = place[order], spans["start"].to_numpy()[order], spans["end"].to_numpy()[order]
        out = []
        for i, (doc, text) in enumerate(zip(rows["doc_id"].to_pylist(), binary_list(rows, "text"))):
            units = cutter.cut(text)
            lo, hi = np.searchsorted(place, [i, i + 1])
            if lo == hi:
                out.append((doc, len(units), 0, [], cutter.kept(units, None)))
                continue
            gone = _spans_to(len(units), start[lo:hi], end[lo:hi])
            flip = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            pairs = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(flip == 1).tolist(),
                                                           np.flatnonzero(flip == -1).tolist())]
            out.append((doc, len(units), int(gone.sum()), pairs, cutter.kept(units, gone)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _KEPT)], schema=_KEPT) \
            if out else _KEPT.empty_table()

    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        strip, "doc_id long, n_units long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")


_SENT = pa.schema([("key", pa.int64()), ("part", pa.binary()), ("doc", pa.int64()), ("block", pa.int32()),
                   ("place", pa.int32()), ("start", pa.int64()), ("windows", pa.int64()), ("again", pa.bool_())])
_SPAN = pa.schema([("block", pa.int32()), ("place", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
