"""Line dedup, its cuckoo filters and the bitmap of verdicts against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.llm import verdicts
from agora.llm.cuckoo import CuckooFilter
from agora.llm.line_dedup import line_dedup, line_index
from agora.llm.verdicts import maybe_in, named_rows

SCHEMA = "doc_id long, text string, lines int, key string, hash string, gone int, kept string"


def docs_of(spark, pairs):
    return spark.createDataFrame([(d, t, 1, "k", "h", 2, "z") for d, t in pairs], SCHEMA)


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


def brute(pairs, min_chars, min_docs):
    holders = defaultdict(set)
    for d, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in pairs:
        lines = (t or "").split("\n")
        left = []
        for line in lines:
            held = holders.get(key(line), ())
            if len(held) < min_docs or d == max((h for h in held if h is not None), default=None):
                left.append(line)
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = [("Lïne %d " % i) * rng.choice([1, 2, 3]) for i in range(60)] + ["", " ", "x"]
    pairs = [(i, "\n".join(rng.choice(["", "  ", "\t", "\x0b"]) + rng.choice([str, str.upper])(rng.choice(pool)) + rng.choice(["", " \r"])
                           for _ in range(rng.choice([0, 1, 4, 30])))) for i in rng.sample(range(1000), n)]
    pairs += [(2000 + i, pairs[0][1]) for i in range(30)]  # a group of copies
    pairs += [(None, pairs[1][1]), (None, pairs[2][1]), (None, None), (None, "only here and nowhere else"), (5000, None), (5001, ""),
              (5002, "\n\n"), (pairs[3][0], pairs[3][1]), (pairs[3][0], pairs[4][1]), (6000, (pool[1] + "\n") * 3000)]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("sizes", [{}, {"batches": 1}, {"batches": 4, "keys_per_shard": 4}, {"batches": 3, "shards": 1, "keys_per_shard": 4}])
def test_lines(spark, sizes):
    pairs = corpus(len(sizes))
    for min_docs in (2, 3):
        got = line_dedup(docs_of(spark, pairs).repartition(3), 12, min_docs, **sizes).collect()
        assert sorted(map(tuple, got), key=repr) == brute(pairs, 12, min_docs)


def test_lines_of_an_empty_table(spark):
    assert line_dedup(docs_of(spark, [(1, "a")]).limit(0)).collect() == []


def state(index):
    counts = {bytes(r.key): (r.n_docs, r.last_doc) for r in index.counts.collect()}
    filters = {r.shard: CuckooFilter(index.buckets, r.filter) for r in index.filters.collect()}
    held = Counter()
    for r in index.counts.select("key", index._shard()).collect():
        held[r.shard] += 1
        assert filters[r.shard].contains(np.frombuffer(bytes(r.key)[:8], np.uint64)).all()
    assert {s: len(f) for s, f in filters.items() if len(f)} == dict(held)  # one fingerprint for each key counted
    return counts


def test_deletion_reverses_insertion(spark):
    pairs = corpus(9)
    first, second, third = ([p for p in pairs if (p[0] or 0) % 3 == i] for i in range(3))
    empty = line_index(docs_of(spark, pairs), min_chars=12, keys_per_shard=16)
    one = empty.insert(docs_of(spark, first))
    both = one.insert(docs_of(spark, second))
    again = both.delete(docs_of(spark, second)).delete(docs_of(spark, [(424242, "never inserted")]))
    assert state(again) == state(one)
    more = again.insert(docs_of(spark, third))
    assert state(more) == state(empty.insert(docs_of(spark, first + third)))
    assert sorted(map(tuple, more.clean(docs_of(spark, first + third)).collect()), key=repr) == brute(first + third, 12, 3)
    assert state(more.delete(docs_of(spark, first + third))) == {}


@pytest.mark.parametrize("buckets, n", [(1, 3), (2, 40), (64, 200), (64, 1000), (1024, 3500)])
def test_cuckoo(buckets, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, 2 * n))
    rng.shuffle(keys)
    f = CuckooFilter(buckets)
    f.add(keys[:n // 2])
    f.add(keys[n // 2:n])
    f = CuckooFilter(buckets, f.to_bytes())
    assert f.contains(keys[:n]).all() and len(f) == n
    if buckets > 1:
        assert f.contains(keys[n:]).mean() < 0.01 + 8 * len(f.segments) * 2 / 65536 * 4
    gone, stay = keys[:n:2], keys[1:n:2]
    f.remove(gone)
    assert f.contains(stay).all() and len(f) == len(stay)
    f.add(gone)
    f.remove(keys[:n])
    assert len(f) == 0
    with pytest.raises(KeyError):
        f.remove(keys[:1])


def test_bitmap_of_verdicts(spark, monkeypatch):
    monkeypatch.setattr(verdicts, "MOST_BITS", 1 << 17)
    docs = spark.range(20_000).withColumn("h", F.lit("x")).withColumn("__map", F.lit(1))
    members = spark.range(0, 20_000, 7).select(F.xxhash64("id").alias("h"))
    got = maybe_in(docs, F.xxhash64("id"), members, "some")
    assert got.columns == ["id", "h", "__map", "some"]
    flags = {r.id: r.some for r in got.select("id", "some").collect()}
    assert len(flags) == 20_000 and all(flags[i] for i in range(0, 20_000, 7))
    assert sum(flags.values()) < 4000
    assert not maybe_in(docs, F.xxhash64("id"), members.limit(0), "some").where("some").count()


def test_row_names_are_the_same_in_every_scan(spark, tmp_path):
    spark.range(1000).withColumn("_metadata", F.lit("x")).repartition(3).write.parquet(str(tmp_path / "t"))
    for docs in (spark.read.parquet(str(tmp_path / "t")), spark.range(1000).withColumn("row", F.lit(1))):
        named = named_rows(docs)
        assert named.select("doc.*").columns == docs.columns and named.select("row").distinct().count() == 1000
        again = named.repartition(7).select(F.col("doc.id").alias("same"), F.col("row").alias("r"))
        assert named.join(again, F.col("r") == F.col("row")).where("doc.id = same").count() == 1000
