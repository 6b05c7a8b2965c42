"""Ranked search against a plain scan of all texts."""

import random

import pytest
from pyspark.sql import functions as F

from lexframe.operators import search as S

RANKS = {"key": 0, "note": 2}


def plain(terms, queries, limit):
    out = []
    for qid, raw in queries:
        q = raw.strip().lower()
        if not q:
            continue
        best = {}
        for key, n, text, kind, context, weight in terms:
            t = text.lower()
            if q in t:
                rank = RANKS.get(kind, S.OTHER_KIND) if t == q else S.PARTIAL
                old = best.get(key)
                kept = min(old[0], (rank, n, kind, text, context)) if old else (rank, n, kind, text, context)
                best[key] = (kept, max(weight, old[1]) if old else weight)
        order = sorted(best.items(), key=lambda e: (e[1][0][0], -e[1][1], e[0]))
        out += [(qid, raw.strip(), i + 1, k, b[2], b[3], b[4], b[0] < S.PARTIAL, len(best)) for i, (k, (b, _)) in enumerate(order[:limit])]
    return sorted(out)


def found(spark, terms, queries, limit):
    t = spark.createDataFrame(terms, "key string, ord int, text string, kind string, context string, weight long")
    q = spark.createDataFrame(queries, "qid string, query string")
    return sorted(tuple(r) for r in S.search(t, q, RANKS, limit).collect())


@pytest.fixture
def terms():
    rng = random.Random(3)
    out = []
    for k in range(60):
        for n in range(rng.randint(1, 3)):
            text = "".join(rng.choice("abcé 日") for _ in range(rng.choice([1, 2, 3, 8, 40, 700])))
            out.append((f"k{k}", n, text if text.strip() else "a", rng.choice(["key", "note", "other"]), "c", k % 5))
    return out + [("z", 0, "Needle", "key", "c", 9), ("z", 1, "x" * 900 + "needle" + "y" * 900, "note", "c", 9)]


def test_search(spark, terms):
    rng = random.Random(4)
    asked = ["a", "é", "ab", "日b", "abc", "needle", "NEEDLE", " a ", "", "  ", "zzz", "q", "xneedley"]
    asked += [t[2][i : i + n] for t in rng.sample(terms, 12) for i, n in ((0, 5), (1, 3), (0, len(t[2])))]
    queries = [(f"q{i}", q) for i, q in enumerate(asked)]
    assert found(spark, terms, queries, 7) == plain(terms, queries, 7)


def test_long_queries_and_dealt_probes(spark, terms, monkeypatch):
    """Queries longer than what is compared on the spot, and probes that are not broadcast."""
    monkeypatch.setattr(S, "PIECE", 6)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    long = max((t[2] for t in terms), key=len)
    queries = [("a", long), ("b", long[:30]), ("c", long[:29] + "!"), ("d", "needle"), ("e", "ab"), ("f", "x" * 20 + "needle")]
    assert found(spark, terms, queries, 50) == plain(terms, queries, 50)
    assert found(spark, [], queries, 5) == [] and found(spark, terms, [("a", " ")], 5) == []


def test_pairs_are_found_once(spark):
    """A query that stands often in a record comes once, also where the record has several blocks; lower bands are left out."""
    texts = spark.createDataFrame([("a", 5, "banana" + S.PAD * 2), ("b", 9, "an" * 900 + S.PAD * 2)], "key string, weight long, text string").withColumn("band", S.band(F.col("weight")))
    probe = S.probes(spark.createDataFrame([("an",), ("nan",), ("n",), ("x",)], "q string"), S.gram_counts(texts))
    assert sorted(tuple(r) for r in S.pairs(texts, probe, 3).select("key", "q").collect()) == [(k, q) for k in "ab" for q in ("an", "n", "nan")]
    assert {r.key for r in S.pairs(texts, probe, 3, F.col("band") >= 9).collect()} == {"b"}


def test_bands_keep_the_order(spark):
    values = sorted({s * (2**k + d) for k in range(62) for d in (-1, 0, 1) for s in (-1, 1)} | {-(2**63), 2**63 - 1})
    rows = spark.createDataFrame([(v,) for v in values], "w long").select("w", S.band(F.col("w")).alias("b")).orderBy("w").collect()
    assert all(r.b <= r.w for r in rows) and [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(r.b == r.w for r in rows if abs(r.w) < 2**S.BAND_BITS)


@pytest.mark.parametrize("scale", [1, -1000, 10**12])
def test_first_by_weight(spark, scale):
    """Only the matches that can be shown are sorted: the places are those of all, ties and exact hits included."""
    terms = [(f"k{i:03}", 0, "abc" if i % 50 == 7 else f"xabc{i}", "key", "c", (i * 37 % 101) * scale) for i in range(300)]
    assert found(spark, terms, [("q", "abc"), ("r", "c1")], 9) == plain(terms, [("q", "abc"), ("r", "c1")], 9)
