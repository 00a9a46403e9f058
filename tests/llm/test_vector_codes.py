"""Vector codes against a full scan in plain integers."""

import hashlib
import math

import numpy as np
import pytest

from agora.llm.vector_codes import LIMIT, assign, compress_vectors, group_starts, net_displacements

SCHEMA = "vec_id long, embedding array<float>, label string, code int, ints string, error string"


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label), whole ones only, in the order that picks the first entries."""
    x = [[max(-LIMIT, min(LIMIT, math.floor(256 * float(np.float32(c))))) for c in v] for _, v, _ in rows]
    w = len(x[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in x]
    book = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def near(p, c):
        return min((sum((a - b) ** 2 for a, b in zip(c, e)), j) for j, e in enumerate(book[p]))

    for _ in range(rounds):
        code = [[near(p, v[p])[1] for p in range(parts)] for v in cut]
        for p in range(parts):
            for j in range(len(book[p])):
                own = [v[p] for v, k in zip(cut, code) if k[p] == j]
                if own:
                    book[p][j] = [sum(c) // len(own) for c in zip(*own)]
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    return [("".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f)) for f in found], \
        hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()


@pytest.mark.parametrize("rounds, groups, entries", [(0, 8, 64), (1, 3, 10), (2, 8, 64), (6, 4, 16), (6, 16, 16)])
def test_codes(spark, rounds, groups, entries):
    rng = np.random.default_rng(rounds + groups)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(scale=0.2, size=8)).astype(np.float32).tolist(), "ab"[i % 2] if i % 5 else None)
            for i in range(300)]
    rows += [(i, rows[i - 290][1], None) for i in range(300, 320)]  # repeated vectors
    rows.append((400, [1e30, -1e30] + [0.0] * 6, "a"))  # clamped
    bad = [(900, None, "a"), (901, [1.0] * 7 + [None], "a"), (-902, [math.nan] * 8, "a"), (903, [math.inf] + [0.0] * 7, "b"),
           (904, [1.0] * 4, "a"), (905, [], None)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows + bad], SCHEMA).repartition(5)
    got = compress_vectors(df, parts=4, entries=entries, rounds=rounds, groups=groups)
    want, books = brute(rows, 4, entries, rounds)
    found = {r.vec_id: (r.code.hex(), r.error, r.label) for r in got.rows.collect()}
    assert found == {r[0]: (*w, r[2]) for r, w in zip(rows, want)}
    assert got.digest() == books


def test_bounds_spare_scans_and_change_nothing():
    """Slowly moving entries: most groups keep their bound, whatever its stamp."""
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, (400, 4))
    books, starts = [x[:32].astype(np.int64)], group_starts(32, 8)
    state, held = (), 0
    for _ in range(8):
        entry, error, low, stamp, spared = assign(x, np.stack(books), starts, *state)
        full = ((x[:, None, :] - books[-1]) ** 2).sum(axis=2)
        assert (entry == full.argmin(axis=1)).all() and (error == full.min(axis=1)).all()
        state, held = (entry, low, stamp), held + spared
        books.append(books[-1] + rng.integers(-9, 10, books[-1].shape))
    assert held > 400 * 8 * 2 and len(set(state[2].ravel().tolist())) > 2


def test_net_displacement_is_less_than_drift():
    there = np.array([[[0, 0]], [[9, 0]], [[1, 0]]])  # away and back
    assert net_displacements(there, np.array([0])).ravel().tolist() == [1.0, 8.0, 0.0]


def test_codes_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, [0.5, 1.5]), (1, [0.25, -1.5]), (None, [0.0, 0.0])], "vec_id long, embedding array<double>") \
        .selectExpr("*", "1 as label")
    got = compress_vectors(df, parts=2, entries=64, rounds=2)
    assert [(r.vec_id, r.code.hex(), r.error) for r in got.rows.orderBy("vec_id", "code").collect()] == [
        (None, "0202", 0), (1, "0000", 0), (1, "0101", 0)]
    none = compress_vectors(df.limit(0))
    assert none.rows.count() == 0 and none.rows.columns == got.rows.columns
    with pytest.raises(ValueError, match="equal parts"):
        compress_vectors(df, parts=3)
