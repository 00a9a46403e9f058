"""Exact, SimHash, substring and suffix dedup against brute force."""

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.llm.components import connected_components
from agora.llm.exact_dedup import drop_copies, exact_dedup
from agora.llm.simhash import drop_near_copies, fingerprint, near_links, simhash_dedup, within_radius, bit_planes
from agora.llm.substring_dedup import SuffixAutomaton, substring_dedup
from agora.llm.suffix_dedup import Shard, merge_transforms, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, hash string, kept string"


def docs_of(spark, pairs):
    return spark.createDataFrame([(d, t, None, "s", None, 1, "x", "y") for d, t in pairs], SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, "Aé B"), (4, "aé b"), (5, "AÉ b"), (4, "aé b"), (None, "aé b"), (None, None),
           (9, " \t\n"), (10, "word " * 5000), (11, "WORD " * 5000)]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, keep, weak):
    """A hash that collides for all texts changes nothing: bytes decide."""
    kw = {"content_hash": lambda c: F.lit("same")} if weak else {}
    got = exact_dedup(docs_of(spark, AWKWARD), keep, **kw).collect()
    groups = {}
    for d, t in AWKWARD:
        groups.setdefault(lower(t), []).append(d)
    pick = min if keep == "smallest" else max
    want = []
    for d, t in AWKWARD:
        ids = groups[lower(t)]
        k = pick([i for i in ids if i is not None], default=None)
        want.append((d, k, len(ids), d == k, hashlib.sha256(lower(t).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_one_row_stays_whatever_the_hash(spark, keep):
    want = sorted(r.text or "" for r in drop_copies(docs_of(spark, AWKWARD), keep).collect())
    assert want == sorted(r.text or "" for r in drop_copies(docs_of(spark, AWKWARD).repartition(3), keep, lambda c: F.lit("same")).collect())
    assert len(want) == len({lower(t) for _, t in AWKWARD})


def test_exact_keeps_columns_and_takes_empty_tables(spark):
    docs = docs_of(spark, AWKWARD)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 5, 9, 10]
    assert drop_copies(docs.limit(0)).count() == 0 and exact_dedup(docs.limit(0)).count() == 0


def test_a_repeated_id_loses_no_group(spark):
    """An id with two texts: dropped for one, the only holder of the other."""
    rows = [(1, "one " * 30), (5, "one " * 30), (5, "other " * 40), (None, "two"), (None, "one " * 30)]
    assert sorted((r.doc_id or 0, r.text[:3]) for r in drop_copies(docs_of(spark, rows)).collect()) \
        == [(0, "two"), (1, "one"), (5, "oth")]
    near = drop_near_copies(docs_of(spark, [r for r in rows if r[0]])).collect()
    assert {r.text[:3] for r in near} == {"one", "oth"}


def test_one_row_of_each_text_stays(spark):
    """Repeated and null ids: one row per text, and one per component."""
    a, b, c = "one " * 30, "other " * 40, "third thing"
    rows = [(1, a)] * 3 + [(1, b), (5, a), (5, b), (None, a), (None, a.upper())] + [(None, c)] * 4
    docs = docs_of(spark, rows).repartition(3)
    for keep, want in (("smallest", [(0, c), (1, a), (1, b)]), ("largest", [(0, c), (5, a), (5, b)])):
        assert sorted((r.doc_id or 0, r.text) for r in drop_copies(docs, keep).collect()) == want
    left = drop_near_copies(docs, judge_null_ids=True)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, c), (1, a), (1, b)]
    assert sorted((r.doc_id or 0, r.text) for r in drop_near_copies(docs.where("doc_id is not null")).collect()) == [(1, a), (1, b)]
    near = [(7, " ".join(f"w{i}" for i in range(300))), (None, " ".join(f"W{i}" for i in range(300)))]
    assert [r.doc_id for r in drop_near_copies(docs_of(spark, near), judge_null_ids=True).collect()] == [7]


def components_of(ids, linked):
    par = list(range(len(ids)))

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, j in linked:
        a, b = root(i), root(j)
        par[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return [min((x for x in groups[root(i)] if x is not None), default=None) for i in range(len(ids))]


def test_simhash(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    pairs = list(AWKWARD)
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 200]))]
        pairs.append((100 + 3 * i, " ".join(text)))
        text[rng.randrange(len(text))] = "changed"
        pairs.append((101 + 3 * i, " ".join(text)))
    fps = np.array([fingerprint((t or "").encode(), 3) for _, t in pairs], np.uint64)
    close = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 2)]
    want = sorted(zip([d for d, _ in pairs], [f"{int(f):016x}" for f in fps],
                      components_of([d for d, _ in pairs], close)), key=repr)
    docs = docs_of(spark, pairs)
    assert sorted(map(tuple, simhash_dedup(docs).collect()), key=repr) == want
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((d for d, _, c in want if d == c or d is None), key=repr)
    assert simhash_dedup(docs.limit(0)).count() == 0


def test_fingerprint_is_the_majority_of_xxh64(spark):
    text = "The quick brown\tfox jumps over The quick brown dog"
    words = text.lower().split()
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [r.h & (2**64 - 1) for r in spark.createDataFrame([(s,) for s in shingles], "s string")
              .select(F.xxhash64("s").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint(text.encode(), 3) == want


def test_bit_sliced_distances():
    rng = np.random.default_rng(3)
    q = rng.integers(0, 2**63, 64, dtype=np.uint64)
    f = q ^ (np.uint64(1) << rng.integers(0, 64, 64, dtype=np.uint64))
    for radius in (0, 1, 2, 3, 5):
        alive, near = within_radius(q[None], bit_planes(f), radius)
        want = np.bitwise_count(q[:, None] ^ f[None]) <= radius
        got = np.zeros((64, 64), bool)
        if len(alive):
            got = (near[0][:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool)
        assert (got == want).all()


def test_dense_group_sends_a_star_not_all_pairs(spark):
    base = 0x123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a, b in product(range(40), repeat=2)})
    links = near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
    assert links.count() <= 10 * len(fps)
    assert {r.root for r in connected_components(links).collect()} == {min(fps)}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 102), (102, 101)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 101: 100, 102: 100}
    assert connected_components(edges.limit(0)).count() == 0


def brute_repeats(pairs, window, by_words):
    seen, out = set(), []
    for d, t in sorted(pairs, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        data = (t or "").encode()
        units = data.split() if by_words else data
        gone = [False] * len(units)
        for i in range(len(units) - window + 1):
            key = tuple(units[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        kept = [u for u, g in zip(units, gone) if not g]
        out.append((d, len(units), sum(gone), sum(g and not p for g, p in zip(gone, [False, *gone])),
                    b" ".join(kept) if by_words else bytes(kept)))
    return sorted(out, key=repr)


def pieces(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "c", "dd", "é"][:2 + seed % 4]
    base = [[rng.choice(letters) for _ in range(40)] for _ in range(5)]
    pairs = []
    for i in range(60):
        text = []
        for _ in range(rng.choice([0, 1, 2, 3])):
            a = rng.randrange(30)
            text += rng.choice(base)[a:a + rng.randrange(25)] + [rng.choice(letters)] * rng.choice([0, 1, 5])
        pairs.append((i, " ".join(text)))
    return pairs + [(200, "a " * 300), (201, "a b " * 100), (202, None), (203, ""), (7, pairs[7][1]), (None, pairs[9][1])]


@pytest.mark.parametrize("dedup, by_words, window", [
    (substring_dedup, True, 5), (substring_dedup, True, 20), (suffix_dedup, False, 5), (suffix_dedup, False, 13),
    (suffix_dedup, False, 50)])
@pytest.mark.parametrize("options", [{}, {"block_bytes": 600}, {"block_bytes": 600, "hot": 3}])
def test_repeats(spark, dedup, by_words, window, options):
    for seed in (1, 2):
        pairs = pieces(seed)
        got = dedup(docs_of(spark, pairs), window, **options)
        rows = sorted(((r[0], r[1], r[2], len(r[3]), r[4].encode() if by_words else bytes(r[4])) for r in got.collect()), key=repr)
        assert rows == brute_repeats(pairs, window, by_words)


def test_repeats_of_empty_tables(spark):
    for dedup in (substring_dedup, suffix_dedup):
        assert dedup(docs_of(spark, []), 20).count() == 0
        assert [r.n_removed for r in dedup(docs_of(spark, [(1, None)]), 20).collect()] == [0]


def test_automaton_matching_statistics():
    rng = random.Random(4)
    automaton, before = SuffixAutomaton(), []
    for _ in range(30):
        text = [rng.choice("ab") for _ in range(rng.randrange(12))]
        for i, m in enumerate(automaton.feed(text)):
            known = {tuple(s[a:b]) for s in [*before, text[:i]] for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
            longest = max((n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in known), default=0)
            assert m == longest
        before.append(text)


def test_merged_transforms_order_all_suffixes():
    rng = np.random.default_rng(5)
    parts = [rng.integers(97, 99, n).astype(np.uint8) for n in (1, 30, 64, 200)]
    for depth in (3, 8, 20):
        block, place = merge_transforms([Shard(p, depth) for p in parts], depth)
        base = np.cumsum([0, *map(len, parts)])
        keys = []
        for p in place:
            s = np.searchsorted(base, p, "right") - 1
            keys.append(np.resize(np.roll(parts[s], base[s] - p), depth).tobytes())
        assert keys == sorted(keys) and sorted(place) == list(range(base[-1]))
        assert [a == b for a, b in zip(keys, keys[1:])] == (np.diff(block.astype(int)) == 0).tolist()
