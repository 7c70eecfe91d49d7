"""Vector codes against plain k-means over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from drayage.llm import vector_codes


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes and errors of (key, vector) rows by measuring everything against everything."""
    points = [[math.floor(scale * x) for x in v] for _, v in rows]
    size = len(points[0]) // parts
    cut = [[p[i * size : (i + 1) * size] for i in range(parts)] for p in points]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1]))[:entries]
    books = [[list(cut[i][part]) for i in first] for part in range(parts)]

    def nearest(part, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[part]))

    for _ in range(rounds):
        for part in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(part, c[part])[1], []).append(c[part])
            for n, members in groups.items():
                books[part][n] = [sum(column) // len(members) for column in zip(*members)]
    found = [[nearest(part, c[part]) for part in range(parts)] for c in cut]
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    codes = [("".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f)) for f in found]
    return codes, hashlib.sha256(numbers.encode()).hexdigest()


@pytest.mark.parametrize("k,spread", [(16, 40), (16, 3), (5, 10), (2, 4), (1, 9), (40, 300)])
def test_bounds_give_exact_assignments(k, spread):
    rng = np.random.default_rng(k * 100 + spread)
    x = rng.integers(-spread, spread + 1, (400, 4))
    books = rng.integers(-spread, spread + 1, (k, 4))
    known, most = vector_codes.measured(x, books, max(1, k // 4)), max(1, k // 4)
    for step in range(12):
        moved = books + rng.integers(-2, 3, books.shape) * (rng.random((k, 1)) < 0.5) * (9 if step % 5 == 4 else 1)
        drift = vector_codes.roots(np.square(moved - books).sum(axis=1))[1]
        books = moved
        known, most = vector_codes.assign(x, books, vector_codes.moved(known, drift, most), most)
        squares = np.square(x[:, None] - books).sum(axis=2)
        assert (known.nearest == squares.argmin(axis=1)).all()
        own = np.take_along_axis(squares, known.nearest[:, None], 1)[:, 0]
        assert (known.upper >= 0).all() and (known.upper.astype(float) ** 2 >= own).all()
        # Every bound holds for its entry and all later ones, listed or not.
        for j in range(known.ranked.shape[1] + 1):
            seen = np.column_stack([known.nearest, known.ranked[:, :j]])
            rest = squares.copy()
            np.put_along_axis(rest, seen, np.iinfo(np.int64).max, 1)
            limit = known.lower[:, j] if j < known.ranked.shape[1] else known.outer
            assert (np.maximum(limit, 0).astype(float) ** 2 <= rest.min(axis=1)).all()
        assert 0 <= most < max(k, 2)


def test_roots_are_exact():
    squares = np.array([0, 1, 2, 3, 4, (1 << 30) ** 2 - 1, (1 << 30) ** 2, (1 << 30) ** 2 + 1])
    down, up = vector_codes.roots(squares)
    assert down.tolist() == [math.isqrt(s) for s in squares.tolist()]
    assert up.tolist() == [math.isqrt(s) + (math.isqrt(s) ** 2 < s) for s in squares.tolist()]


SCHEMA = "vec_id long, embedding array<float>, label int, key string, code int"


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(12)]
    rows = []
    for i in range(300):
        vector = [np.float32(c + rng.gauss(0, 0.1)).item() for c in rng.choice(centres)]
        rows.append((1000 - i, vector, rng.choice([None, 1, 1, 2])))
    rows += [(5000, rows[0][1], 1)] * 200  # a hot vector and label, repeated rows
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA).repartition(5)
    got = vector_codes.compress(frame).collect()
    codes, digest = plain([r[:2] for r in rows])
    totals = {}
    for (_, _, label), (_, error) in zip(rows, codes):
        totals[label] = totals.get(label, 0) + error
    wanted = sorted((r[0], str(r[2]), *c, totals[r[2]]) for r, c in zip(rows, codes))
    assert sorted((r.key, str(r.label), bytes(r.code).hex(), r.error, r.label_error) for r in got) == wanted
    assert {r.codebooks for r in got} == {digest}


def test_odd_vectors(spark):
    good = [0.5, -0.25] * 8
    rows = [
        (1, [], 1), (2, good, None), (3, None, 1), (4, [*good[:15], None], 1), (5, [*good[:15], float("nan")], 1),
        (6, [*good[:15], float("inf")], 1), (7, good[:15], 2), (8, good[:8], 3), (9, [2000.0] * 16, 4), (None, good, 4),
    ]
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    got = {r.key: r for r in vector_codes.compress(frame).collect()}
    assert set(got) == {1, 2, 7, 8, 9, None}
    assert {k for k, r in got.items() if r.code is None} == {1, 7, 8, 9}
    assert got[2].error == got[None].error == 0 and got[2].label_error == got[9].label_error == 0
    assert got[7].label_error is None and bytes(got[2].code) == bytes(8)
    assert vector_codes.compress(frame.limit(0)).count() == 0
    unusable = vector_codes.compress(frame.where("vec_id IN (1, 3, 7)")).collect()
    assert sorted(r.key for r in unusable) == [1, 7] and all(r.code is None for r in unusable)
