"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-Proximal.

Features are hashes of words, of word shapes (letters and digits folded, marks kept) and of pairs of
neighbours, each with weight count / number of n-grams, so a score is a sparse dot product. The
model is fitted on a bounded sample of labelled rows; all texts are scored in Arrow batches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexframe.llm.common import named
from lexframe.llm.tokens import Memo

BUCKETS = 2**18
#: labelled rows that are fitted on, the first by a hash of their id: the bound of the sample
MAX_ROWS = 6000
EPOCHS = 3
THRESHOLD = 0.3
LETTER_RUN, DIGIT_RUN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
_U = np.uint64


def _word_codes(word: str) -> int:
    """Two 32-bit hashes in one number: of the lower-cased word and of its shape."""
    shape = DIGIT_RUN.sub("9", LETTER_RUN.sub(lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a", word))
    return zlib.crc32(word.lower().encode("utf-8", "replace")) << 32 | zlib.crc32(shape.encode("utf-8", "replace"))


def _spread(x: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + _U(salt)) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> _U(32))) % _U(buckets)).astype(np.int64)


class Features:
    """Feature numbers of a text, one for each n-gram; an empty text has none."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.codes = buckets, Memo(_word_codes)

    def __call__(self, text: str | None) -> np.ndarray:
        codes = np.array([self.codes[w] for w in (text or "").split()], np.uint64)
        found = []
        for salt, x in ((1, codes >> _U(32)), (3, codes & _U(0xFFFFFFFF))):
            found.append(_spread(x, salt, self.buckets))
            with np.errstate(over="ignore"):
                # a word that follows itself is a feature of its own, whatever the word
                pairs = np.where(x[1:] == x[:-1], _U(0), x[:-1] * _U(0x100000001B3) + x[1:])
            found.append(_spread(pairs, salt + 1, self.buckets))
        return np.concatenate(found)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        margin = self.bias + (float(self.weights[features].mean()) if len(features) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, epochs: int = EPOCHS, alpha: float = 200.0, beta: float = 1.0, l1: float = 0.0, l2: float = 1e-4) -> Model:
    """FTRL-Proximal over (features, shares, label) rows, in the order given.

    Without rows, the model scores 0.5 everywhere; rows of one label give a bias towards it.
    """
    z, n = np.zeros(buckets), np.zeros(buckets)
    bias_z = bias_n = 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for at, share, label in rows:
            share = share.astype(np.float64)  # kept compact between the rounds
            zs, ns = z[at], n[at]
            w = weight(zs, ns)
            bias = -bias_z / ((beta + bias_n**0.5) / 0.5)
            p = 1 / (1 + np.exp(-np.clip(bias + w @ share, -35, 35)))
            g = (p - label) * share
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            gb = float(p - label)
            bias_z += gb - ((bias_n + gb * gb) ** 0.5 - bias_n**0.5) / 0.5 * bias
            bias_n += gb * gb
    return Model(weight(z, n), float(-bias_z / ((beta + bias_n**0.5) / 0.5)))


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 0; a row without id is not held out."""
    return F.coalesce(F.crc32(named(key).cast("string")) % 5 == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS, buckets: int = BUCKETS) -> Model:
    """Fit on at most ``max_rows`` labelled documents that are not held out, chosen by a hash of the id.

    Of a repeated id the row with the least text hash is taken. Null keys, labels other than 0 and 1, and labels without a document are passed over.
    """
    y, k = named(label), named(key)
    marked = labels.where(y.isin(0, 1) & k.isNotNull() & ~held_out(key)).groupBy(k.alias("k")).agg(F.min(y).cast("int").alias("y"))
    texts = docs.select(k.alias("id"), named(text).alias("t"))
    known = marked.join(texts.select("id"), F.col("k") == F.col("id"), "left_semi")
    chosen = known.orderBy(F.xxhash64("k"), "k").limit(max_rows)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Features(buckets)
        for batch in batches:
            rows = []
            for k, y, value in zip(batch["k"], batch["y"], batch["t"], strict=True):
                at, counts = np.unique(of(value), return_counts=True)
                rows.append((k, y, at.astype("<u4").tobytes(), (counts / max(1, counts.sum())).astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["k", "y", "at", "share"])

    # one row per id before any features are made: the row with the least text hash
    least = F.min(F.struct(F.xxhash64("t").alias("h"), F.col("t")))["t"]
    single = texts.join(F.broadcast(chosen), F.col("k") == F.col("id")).groupBy("k").agg(F.min("y").alias("y"), least.alias("t"))
    sample = single.select(F.col("k").cast("string").alias("k"), "y", "t")
    found = sample.mapInPandas(features, "k string, y int, at binary, share binary").collect()  # max_rows rows, at most ``buckets`` numbers each
    found.sort(key=lambda r: (zlib.crc32(r.k.encode()), r.k, r.at))
    return fit([(np.frombuffer(r.at, "<u4"), np.frombuffer(r.share, "<f4"), r.y) for r in found], buckets)


def score(spark: SparkSession, docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted.

    Null and empty texts get the score of the bias alone. Equal texts score alike whatever their
    other columns; columns named like a result are replaced. The broadcast weights are bounded by
    the number of hash buckets.
    """
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    buckets = len(model.weights)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, own = Features(buckets), Model(*sent.value)
        for batch in batches:
            yield pd.Series([own.score(of(x)) for x in batch], dtype="float64")

    kept = [named(c) for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    out = docs.select(*kept, held_out(key).alias("held_out"), scored(F.coalesce(named(text), F.lit(""))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
