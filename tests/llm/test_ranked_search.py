"""Block-max MaxScore against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from agora.llm import ranked_search as R
from agora.llm.ranked_search import Best, Shard, Statistics, index_shard, ranked_search, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    lists = [(d, Counter(terms(t))) for d, t in docs]
    lists = [(d, c) for d, c in lists if c]
    n_docs, n_terms = len(lists), sum(sum(c.values()) for _, c in lists)
    df = Counter(t for _, c in lists for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c in lists:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, n in Counter(terms(text)).items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "naïve", "Straße"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 20, 60])))) for i in rng.sample(range(10 * n), n)]
    docs += [(100_000 + i, docs[0][1]) for i in range(25)]  # equal scores
    docs += [(None, docs[1][1]), (None, None), (5, None), (6, ""), (7, " -\n "), (docs[2][0], docs[3][1]), (8, "w1 " * 700 + "W2-w3_É")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 8, 40])))) for i in range(12)]
    items += [(3, "w1 unknown"), (3, "w1 unknown"), (None, "w5 w5 w6"), (50, None), (51, "?!"), (52, "nowhere"), (53, "É w0")]
    rng.shuffle(docs)
    return docs, items


def test_terms():
    text = "".join(map(chr, range(0x180))) + "É9z Ω x"
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("shard_bytes, part_bytes, k", [(1 << 20, 1 << 20, 10), (900, 60, 10), (20_000, 1 << 20, 1), (1, 1 << 20, 3)])
def test_search(spark, shard_bytes, part_bytes, k):
    docs, items = corpus(260, k)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, term string").repartition(3)
    q = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    got = ranked_search(d, q, k, part_bytes, shard_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, k)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, item_id long, text string")
    some = spark.createDataFrame([(1, 1, "a b")], "doc_id long, item_id long, text string")
    for docs, items in ((none, some), (some, none), (none, none), (some.selectExpr("doc_id", "'' text"), some)):
        assert ranked_search(docs, items).collect() == []


def test_candidates_are_rejected_before_decompression(monkeypatch):
    """A rare and a frequent term: once the bar stands, the frequent list's
    blocks are read only where a document with the rare term may pass it."""
    monkeypatch.setattr(R, "WINDOW", 2)
    rng = np.random.default_rng(0)
    texts = [b"common " * int(rng.integers(1, 9)) + (b"rare " if rng.random() < 0.03 else b"") + b"z " * int(rng.integers(0, 90)) for _ in range(20_000)]
    shard = Shard(pa.Table.from_batches(index_shard(0, list(range(len(texts))), texts)), stats := Statistics(
        len(texts), sum(len(t.split()) for t in texts)))
    query = [(t, stats.weight(sum(t.encode() in x.split() for x in texts))) for t in ("common", "rare")]
    blocks = sum(len(shard.block[slice(*shard.at[t])]) for t, _ in query)
    best = Best(10)
    search(shard, query, best)
    assert shard.decompressed < 0.75 * blocks
    full = Best(10)
    score = np.zeros(len(texts), np.int64)
    for t, w in query:
        place, found = shard.postings(*shard.at[t])
        score[place] += w * found
        for b in range(*shard.at[t]):  # the maxima from the front pairs are exact
            assert shard.most[b] == shard.postings(b, b + 1)[1].max()
    full.add(score.tolist(), list(range(len(texts))))
    assert best.found == full.found
