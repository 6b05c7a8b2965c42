"""Strings found by the trie against a plain scan."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexframe.functions import scan as C
from lexframe.operators import search as S


@pytest.fixture(params=[3, 1 << 16])
def chunk(request, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", request.param)


def test_every_string_once(spark, chunk, monkeypatch):
    """Strings of one to many bytes, never inside a character or over the end of a text, always over those of pieces; whole texts at every level."""
    monkeypatch.setattr(C, "LOT", 5)
    rng = random.Random(7)
    rows = [(i, i % 3, ["".join(rng.choice("abé日😀 ") for _ in range(rng.choice([1, 2, 5, 30]))) for _ in range(rng.randint(1, 3))]) for i in range(60)]
    rows += [(60, 1, []), (61, 1, None), (62, 1, ["ab", "cd"]), (63, 1, ["xx", "", "needle" * 5]), (64, 1, ["日"])]
    strings = sorted({t[k : k + n] for _, _, texts in rows[:60] for t in texts for k, n in ((0, 1), (1, 2), (0, 4), (2, 9))} - {""} | {"bc", "abcd", "needle", "zzz", "d", "日", "€"})
    trie = C.build_trie([s.encode() for s in strings], 1 << 20)
    shared = spark.sparkContext.broadcast(tuple(trie))
    levels = [n % 4 for n in range(len(strings))]
    plain = {(i, n): level for i, level, texts in rows for n, s in enumerate(strings) if any(s in t for t in texts or [])}
    df = spark.createDataFrame(rows, "id int, level long, texts array<string>").coalesce(2)
    found = C.found_in(shared, spark.sparkContext.broadcast(np.array(levels)))(F.col("texts"), F.col("level"))
    assert sorted(tuple(r) for r in df.select("id", F.explode(found)).collect()) == sorted(
        k for k, level in plain.items() if levels[k[1]] <= level or strings[k[1]] in (rows[k[0]][2] or []))
    counts = {}
    for (_, n), level in plain.items():
        counts[n, level] = counts.get((n, level), 0) + 1
    tally = df.select("level", "texts").mapInArrow(C.tallied(shared), C.TALLY).groupBy("number", "level").agg(F.sum("n").alias("n"))
    assert {(r.number, r.level): r.n for r in tally.collect()} == counts


def test_bound_of_the_table():
    assert C.build_trie([b"abc", b"abd"], 5 * 5).step.size == 25 and C.build_trie([b"abc", b"abd"], 24) is None


def test_searched_by_trie(spark, monkeypatch):
    """Texts are not opened by character for queries that fit one trie; all others give the same rows by their grams."""
    terms = spark.createDataFrame([(f"k{i}", n, t, "key", "c", i % 4) for i in range(20) for n, t in enumerate(("Straße ab", f"x{i}é"))], "key string, ord int, text string, kind string, context string, weight long")
    queries = spark.createDataFrame([("a", "strasse"), ("b", "é"), ("c", "x1"), ("d", "ßE A"), ("e", "x1é"), ("f", "none")], "qid string, query string")

    def rows():
        return sorted(tuple(r) for r in S.search(terms, queries, {"key": 0}, 6).collect())

    with monkeypatch.context() as m:
        m.setattr(S, "TRIE_CELLS", 0)
        by_grams = rows()

    def opened(*_):
        raise AssertionError("grams")

    monkeypatch.setattr(S, "gram_counts", opened)
    monkeypatch.setattr(S, "pairs", opened)
    assert rows() == by_grams and len(by_grams) == 25


@pytest.mark.parametrize("bound", [0, 2, 500_000])
def test_rows_of_a_key(spark, monkeypatch, bound):
    """Records of one key in several rows are one record, whether those keys are few or many; all others are not dealt."""
    monkeypatch.setattr(S, "BROADCAST_ROWS", bound)
    rows = [("a", 1, ["x"]), ("b", 2, ["y", "xy"]), ("a", 5, ["xz"]), ("c", None, ["x"]), ("d", 3, []), ("e", 1, ["x"]), ("e", 1, ["x"]), ("f", 4, ["zx"])]
    df = spark.createDataFrame(rows, "key string, w int, t array<string>")
    terms = F.transform("t", lambda t: S.term(t, "key", F.lit("c")))
    queries = spark.createDataFrame([("q", "X"), ("r", "xz")], "qid string, query string")
    shown = [tuple(r) for r in S.search(S.gather_terms(df, terms, F.col("w")), queries, {"key": 0}, 4).select("qid", "place", "key", "matched_text", "exact", "total").orderBy("qid", "place").collect()]
    assert shown == [("q", 1, "a", "x", True, 5), ("q", 2, "e", "x", True, 5), ("q", 3, "c", "x", True, 5), ("q", 4, "f", "zx", False, 5), ("r", 1, "a", "xz", True, 1)]
    again = [tuple(r) for r in S.search(S.build_terms(df, terms, F.col("w")), queries, {"key": 0}, 4).select("qid", "place", "key", "matched_text", "exact", "total").orderBy("qid", "place").collect()]
    assert again == shown
