"""Bounds and whole values of the training-data operators."""

import math
import random
from types import SimpleNamespace

import numpy as np
import pytest

from lexframe.llm import hilbert_shards, quality_model, token_store


def test_token_rows_come_from_the_perfect_hash():
    # the hash leads key 7 to document 4: the rows must follow it, not the order of the file
    shard = SimpleNamespace(n_null=1, keys=np.array([7, 7, 9, 11]), documents=lambda keys: np.array([4, 4, 1, -1]))
    assert token_store.located(shard).tolist() == [0, 4, 5, 1, -1]


def test_classifier_bound_holds_for_repeated_ids(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 10 if i < 100 else 3, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    fitted = []
    monkeypatch.setattr(quality_model, "fit", lambda rows, *_: fitted.extend(rows))
    quality_model.train(spark, docs, labels, max_rows=6)
    assert 0 < len(fitted) <= 6


def test_shards_tell_long_sources_apart(spark):
    rows = [(i, "text", f"common-crawl-{i % 4}" if i % 5 else None, "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    cells = {}
    for r in hilbert_shards.shards(docs, buckets=4).collect():
        cells.setdefault(r.source, set()).add(r.cell)
    assert len(cells) == 5 and len(set().union(*cells.values())) == 5


def plain_ftrl(rows, epochs, alpha, beta, l1, l2):
    """FTRL-Proximal feature by feature, in plain floats."""
    z, n, bias_z, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for at, share, label in rows:
            w = {i: weight(i) for i in at}
            bias = -bias_z / ((beta + math.sqrt(bias_n)) / 0.5)
            p = 1 / (1 + math.exp(-(bias + sum(w[i] * s for i, s in zip(at, share)))))
            for i, s in zip(at, share):
                g = (p - label) * s
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
            g = p - label
            bias_z += g - (math.sqrt(bias_n + g * g) - math.sqrt(bias_n)) / 0.5 * bias
            bias_n += g * g
    return {i: weight(i) for i in z}, -bias_z / ((beta + math.sqrt(bias_n)) / 0.5)


@pytest.mark.parametrize(("alpha", "l1"), [(0.5, 0.0), (200.0, 0.0), (0.5, 0.05)])
def test_fit_is_ftrl(alpha, l1):
    rng = random.Random(11)
    rows = []
    for _ in range(80):
        at = sorted(rng.sample(range(50), rng.randint(1, 8)))
        counts = [rng.randint(1, 4) for _ in at]
        rows.append((at, [c / sum(counts) for c in counts], int(min(at) < 10)))
    model = quality_model.fit([(np.array(a), np.array(s), y) for a, s, y in rows], 50, 3, alpha, 1.0, l1, 1e-4)
    weights, bias = plain_ftrl(rows, 3, alpha, 1.0, l1, 1e-4)
    assert model.bias == pytest.approx(bias, abs=1e-9)
    for i in range(50):
        assert model.weights[i] == pytest.approx(weights.get(i, 0.0), abs=1e-8)


def plain_cell(coordinates, bits):
    """The curve's index of a cell by its definition: rotations of ever smaller cubes."""
    x, n = list(coordinates), len(coordinates)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            if x[i] >> level & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = 0
    for level in range(bits - 1, 0, -1):
        if x[-1] >> level & 1:
            turn ^= (1 << level) - 1
    index = 0
    for level in range(bits - 1, -1, -1):
        for value in x:
            index = index << 1 | ((value ^ turn) >> level & 1)
    return index


def test_cells_are_recomputed(spark):
    """Limits at the shares of the rows and the cells that follow, taken anew from the sorted values."""
    rng = random.Random(12)
    rows = [(i, "x" * rng.randint(0, 300) if i % 9 else None, rng.choice(["a", "b", "long-source-name", None]), rng.choice(["de", "en"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    axes = {k: (("1" + s if s is not None else "0"), ("1" + lang if lang is not None else "0"), len(t or "") + 1) for k, t, s, lang in rows}
    limits = []
    for axis in range(3):
        values = sorted(a[axis] for a in axes.values())
        limits.append([values[math.ceil(share * len(values)) - 1] for share in (i / 32 for i in range(1, 32))])
    for r in hilbert_shards.shards(docs, buckets=4).collect():
        wanted = [sum(x < value for x in limit) for value, limit in zip(axes[r.doc_id], limits)]
        assert r.cell == plain_cell(wanted, 5), r
