"""Substring dedup with suffix automata of reference shards.

Each reference shard (all texts around one repeated anchor, see
``repeats``) gets a suffix automaton.  Its texts stream through it in
corpus order: while the automaton is extended by a word, the length of the
longest suffix that it has already held is that word's matching statistic;
where it reaches ``window``, the window that ends there starts earlier,
and the maximal spans of such windows go.

An automaton goes only to the texts that can match in it, not to every
executor: the reference is the corpus itself, so a broadcast of all its
shards would have no bound.

Defined results: null and empty text have no words; a text shorter than
the window stays whole; of rows that repeat a ``doc_id`` the first in the
blocks' order is the earlier one; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.repeats import BLOCK_BYTES, HOT_RUNS, Units, merged, remove_repeats, scattered


class SuffixAutomaton:
    """Of several token sequences; built online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def feed(self, tokens) -> list[int]:
        """Adds a sequence.  Per token: the length of the longest suffix up
        to it that occurs before (in an earlier sequence, or in this one
        ending earlier)."""
        nxt, link, length = self.next, self.link, self.length
        last, matched = 0, []
        for t in tokens:
            to = nxt[last].get(t)
            if to is not None:  # everything read so far has been seen
                last = to if length[to] == length[last] + 1 else self._split(last, t, to)
                matched.append(length[last])
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and t not in nxt[p]:
                nxt[p][t] = new
                p = link[p]
            if p >= 0:
                to = nxt[p][t]
                link[new] = to if length[to] == length[p] + 1 else self._split(p, t, to)
            matched.append(length[link[new]])
            last = new
        return matched

    def _split(self, p: int, t, to: int) -> int:
        """A state for the shorter strings of ``to`` that end in p's plus t."""
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[to]))
        link.append(link[to])
        length.append(length[p] + 1)
        link[to] = new
        while p >= 0 and nxt[p].get(t) == to:
            nxt[p][t] = new
            p = link[p]
        return new


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Words(Units):
    gram = 8

    def __init__(self, window: int):
        self.window, self.gram = window, min(self.gram, window)
        self._cache = None

    def __getstate__(self):
        return {"window": self.window, "gram": self.gram, "_cache": None}

    def cut(self, text: bytes) -> list[bytes]:
        return text.split()  # of bytes: at ASCII white space

    def grams(self, units) -> np.ndarray:
        if self._cache is None or len(self._cache) > 1 << 19:
            self._cache = _Hashes()
        h = np.fromiter(map(self._cache.__getitem__, units), np.uint64, len(units))
        n = len(h) - self.gram + 1
        g = np.zeros(n, np.uint64)
        for i in range(self.gram):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        return scattered(g)

    def join(self, units, start: int, end: int) -> bytes:
        return b" ".join(units[start:end])

    def kept(self, units, removed) -> bytes:
        return b" ".join(units if removed is None else [u for u, r in zip(units, removed.tolist()) if not r])

    def judge(self, groups):
        for g, texts in enumerate(groups):
            automaton = SuffixAutomaton()
            for t, (text, _) in enumerate(texts):
                ends = [i + 1 for i, m in enumerate(automaton.feed(text.split(b" "))) if m >= self.window]
                for a, b in merged([(e - self.window, e) for e in ends]):
                    yield g, t, a, b


def substring_dedup(docs: DataFrame, window: int = 20, block_bytes: int = BLOCK_BYTES, hot: int = HOT_RUNS) -> DataFrame:
    """``doc_id, n_words, n_removed, spans`` (of word positions) and
    ``kept`` (the words left, joined by one space)."""
    return remove_repeats(docs, Words(window), block_bytes, hot).select(
        "doc_id", F.col("n_units").alias("n_words"), "n_removed", "spans", F.col("kept").cast("string").alias("kept"))
