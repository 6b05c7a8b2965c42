"""Set-similarity joins against all pairs."""

import itertools
import random

import pytest

from lexframe.operators import similar

SCHEMA = "g string, ord long, chars array<string>"


def sets(seed, letters, sizes):
    rng = random.Random(seed)
    rows, seen = [], set()
    for g in "xy":
        pool = [rng.sample(letters, rng.choice(sizes)) for _ in range(25)]
        for base in pool + [[c for c in p if rng.random() > 0.1] + rng.sample(letters, rng.randint(0, 2)) for p in pool * 2]:
            s = sorted(set(base))
            if s and (g, tuple(s)) not in seen:
                seen.add((g, tuple(s)))
                rows.append((g, rng.randint(0, 10**9), s))
    return rows


def near(rows, threshold):
    out = []
    for (g, a, s), (h, b, t) in itertools.combinations(sorted(rows, key=lambda r: r[1]), 2):
        s, t = set(s), set(t)
        if g == h and len(s & t) >= threshold * len(s | t) - 1e-9:
            out.append((g, a, b))
    return out


@pytest.mark.parametrize(("seed", "sizes"), [(1, [3, 5, 8]), (2, [9, 10, 12, 14]), (3, [13, 14, 15, 16, 17, 18]), (4, [20, 24]), (5, range(1, 24))])
@pytest.mark.parametrize("threshold", [0.8, 0.75])
def test_pairs(spark, seed, sizes, threshold):
    letters = [chr(c) for c in range(ord("a"), ord("a") + 26)] + list("äöü")
    rows = sets(seed, letters, list(sizes))
    wanted = near(rows, threshold)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.g, r.a, r.b) for r in similar.similar_sets(df, ["g"], "ord", "chars", threshold).collect()) == sorted(wanted)
    first = {r.g: (r.a, r.b) for r in similar.first_similar(df, ["g"], "ord", "chars", threshold).collect()}
    assert first == {g: min((a, b) for h, a, b in wanted if h == g) for g in {w[0] for w in wanted}}
