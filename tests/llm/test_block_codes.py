"""Vector codes against a plain k-means over whole numbers."""

import hashlib
import math

import numpy as np

from lexframe.llm import block_codes


def brute(rows, scale=1024, parts=4, entries=256, rounds=4):
    """Codes of (id, vector, label) rows of one length, by comparing every part with every entry."""
    kept = [(k, [math.floor(scale * x) for x in v], label) for k, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for _, v, _ in kept] for p in range(parts)]
    books = [list(c[:entries]) for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            for i, xs in groups.items():
                books[p][i] = tuple(sum(column) // len(xs) for column in zip(*xs, strict=True))
    found = [[nearest(x, books[p]) for x in cut[p]] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(k, "".join(f"{found[p][i][1]:02x}" for p in range(parts)), sum(found[p][i][0] for p in range(parts)), label) for i, (k, _, label) in enumerate(kept)]
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return [(k, code, error, label, totals[label], sha) for k, code, error, label in out]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return [tuple(r) for r in block_codes.compress(spark, df, **options)[0].collect()]


def test_codes_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)], int(i) % 3 if i % 5 else None) for i in rng.permutation(700)]
    rows += [(700 + i, rows[0][1], 1) for i in range(300)]  # a third are one vector
    rows += [(5, rows[7][1], 2), (5, rows[8][1], 2), (None, rows[9][1], None)]
    assert order(coded(spark, rows)) == order(brute(rows))


def test_codes_of_a_small_codebook(spark, monkeypatch):
    monkeypatch.setattr(block_codes, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [float(round(x, 1)) for x in rng.normal(i % 4, 0.05, 4)], 0) for i in range(200)]
    assert order(coded(spark, rows, entries=5, rounds=3)) == order(brute(rows, entries=5, rounds=3))


def test_odd_vectors(spark):
    good = [(1, [0.5, -0.25, 1.0, 2.0], 1), (2, [0.0, 0.0, 0.0, 0.0], None), (3, [0.5, -0.25, 1.0, 2.0], None)]
    bad = [(4, None, 1), (5, [1.0, None, 1.0, 1.0], 1), (6, [float("nan")] * 4, 1), (7, [float("inf")] * 4, 1), (8, [], 1), (9, [1.0, 2.0, 3.0], 1)]
    assert order(coded(spark, good + bad)) == order(brute(good))
    wide = [(10, [1.0] * 8, 1), (11, [0.0] * 8, 2)]
    both = coded(spark, good + wide)
    assert len(both) == 5 and len({r[5] for r in both}) == 2
    assert coded(spark, bad) == [] and coded(spark, []) == []


def test_large_components(spark):
    rows = [(i, [x, 1.0, -x, 0.0], i % 2) for i, x in enumerate([1e6, 1e12, 1e12 + 4, 3e14, 1e300])]
    out = {r[0]: r for r in coded(spark, rows, entries=2, rounds=2)}
    exact = {r[0]: r for r in brute(rows[:4], entries=2, rounds=2)}
    assert len(out) == 5 and all(0 <= r[2] <= 4 * block_codes.FAR for r in out.values())
    small = {r[0]: r for r in coded(spark, rows[:4], entries=2, rounds=2)}
    assert {k: r[1] for k, r in small.items()} == {k: r[1] for k, r in exact.items()} and small[0][5] == exact[0][5]


def test_clashing_columns(spark):
    rows = [(i, [i / 7, 0.1, 0.2, 0.3], i % 2, 1, 2, 3, 4, 5) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code int, uid int, part int, `a``b` int, sum int")
    plain = coded(spark, [r[:3] for r in rows])
    assert order(tuple(r) for r in block_codes.compress(spark, df)[0].collect()) == order(plain)


def test_curve_neighbours():
    """The curve visits every cell once, each a step from the one before."""
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    index = block_codes.curve_index(grid, 3)
    assert sorted(index) == list(range(512))
    walk = grid[np.argsort(index)]
    assert (abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlist_holds_the_nearest():
    rng = np.random.default_rng(3)
    book, parts = rng.integers(-100, 100, (40, 3)), rng.integers(-20, 10, (60, 3))
    near = block_codes.shortlist(book, parts.min(0), parts.max(0))
    assert len(near) < 40 and set(np.argmin(block_codes.distances(parts, book), axis=1)) <= set(near)
