"""Exact search, near-duplicates and the classifier against brute force or held-out rows."""

import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexframe.llm import components, near_dedup, quality_model, queries, top_k

SF = "/root/testdata/sf0.001"


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 1 + i % 3, 6)]) for i in range(150)]
    rows += [(50, rows[3][1]), (7, None), (None, rows[0][1]), (8, [1.0, None]), (9, [1.0, float("nan")]), (100, [0.5, float("inf")]), (150, [0.25, 0.5]), (151, [1.0, 1.0]), (152, []), (200, []), (300, rows[3][1]), (301, rows[3][1])]
    out = top_k.search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, k=5).collect()
    good = [(k, [math.floor(256 * x) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for q, (k, v) in enumerate(good):
        if k % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(good) if c != q and len(w) == len(v))[:5]
            wanted += [(k, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    assert sorted(map(tuple, out)) == sorted(wanted)
    assert top_k.search(spark, spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 50 == 0).count() == 0


def test_top_k_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])]
    out = top_k.search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0, k=3).collect()
    assert sorted((r.rank, r.vec_id) for r in out) == [(1, 1), (2, 3), (3, 2)]


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute_components(rows):
    sets = [(k, shingle_set(t)) for k, t in rows if k is not None]
    root = {k: k for k, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in root}


def near_rows():
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):  # near copies of one text, edited more and more
        words = list(base)
        for _ in range(i // 6):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        rows.append((1000 - i, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(55))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(60))) for i in range(50)]
    rows += [(1, "a b c"), (2, "A B c"), (3, "a b"), (4, None), (5, ""), (6, " \n"), (7, "a b c d e"), (8, "a b c d e"), (8, "p q r s t"), (9, "P q r s t"), (None, "a b c"), (None, None)]
    return rows


@pytest.mark.parametrize("light", [32, 3])
def test_near_duplicates(spark, monkeypatch, light):
    monkeypatch.setattr(near_dedup, "LIGHT", light)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 2500)
    rows = near_rows()
    docs = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, kept string")
    out = near_dedup.near_duplicates(spark, docs).collect()
    wanted = brute_components(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == wanted.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert sorted(r.n_shingles for r in out) == sorted(len(shingle_set(t)) for _, t in rows)
    assert near_dedup.near_duplicates(spark, docs.limit(0)).count() == 0


def test_near_duplicates_of_documents(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    wanted = brute_components(rows)
    assert {r.doc_id: r.component_id for r in queries.QUERIES["op6_near_dedup"](spark, SF).collect()} == wanted


def test_sketch_slack():
    """A pair at the threshold shares too few sketch values less than once in a million pairs."""
    for n in (80, 100, 200, 1000, 100_000):
        union = n * 100 // 75
        shared, least = math.ceil(union * 0.75), int(near_dedup._needed(np.array([float(n)]))[0])
        ways = math.comb(union, near_dedup.K)
        missed = sum(math.comb(shared, i) * math.comb(union - shared, near_dedup.K - i) for i in range(least) if near_dedup.K - i <= union - shared)
        assert missed / ways < 1e-6


@pytest.mark.parametrize("block", [2**20, 4])
def test_components(spark, block):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (95, 100), (None, 3), (3, None)]
    out = components.components(spark.createDataFrame(edges, "a long, b long"), block).collect()
    assert {r.node: r.component for r in out} == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    assert len(out) == len({r.node for r in out})


def test_classifier_held_out(spark):
    out = queries.QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert out.count() == 1000


def test_classifier_cases(spark):
    rows = [(i, "good words here all the time" if i % 2 else "BAD!! ### BAD!!", "x") for i in range(200)] + [(None, "good words", "x"), (500, None, "x"), (501, "", "x"), (1, "good words here all the time", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (4, 7), (999, 1), (1, 1)], "doc_id long, quality int")
    model = quality_model.train(spark, docs, labels)
    out = quality_model.score(spark, docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.predicted == ("good" in r.text) for r in out if r.text)
    assert len({r.score for r in out if not r.text}) == 1 and not next(r for r in out if r.doc_id is None).held_out
    one = quality_model.train(spark, docs, labels.where("quality = 1"))
    assert all(r.predicted == 1 for r in quality_model.score(spark, docs, one).collect())
    none = quality_model.train(spark, docs.limit(0), labels)
    assert {r.score for r in quality_model.score(spark, docs, none).collect()} == {0.5}
    assert quality_model.score(spark, docs.limit(0), model).count() == 0


def test_contract():
    rng = np.random.default_rng(8)
    for _ in range(30):
        a, b = rng.integers(0, 60, 40), rng.integers(0, 60, 40)
        root = {int(x): int(x) for x in np.concatenate((a, b))}
        for _ in root:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[x] = root[y] = min(root[x], root[y])
        assert dict(zip(*(x.tolist() for x in components.contract(a, b)), strict=True)) == {k: v for k, v in root.items() if k != v}
