"""Rules, license scan, mixing and sharding on small tables with nulls, ties, copies and clashing names."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from lexframe.llm import hilbert_shards, license_scan, mixing, quality_rules

SPACE = "[\x20\x09-\x0d]+"
GOOD = "The cat and the dog went to the house in the town. " * 2 + " ".join(f"word{i} of note" for i in range(30))
TEXTS = [GOOD, None, "", " \n\t ", "a", "a b", "a b c a b c", GOOD, "x\nx\ny\n\nx", "one two three one two three one two", "### $$$ |||", "naïve café " * 40, "w " * 30000]


def repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}) if len(words) < 500 else len(words)


def test_rules(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, kept string")
    for r in quality_rules.verdicts(docs).collect():
        text = r.text or ""
        words = [w for w in re.split(SPACE, text) if w]
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeat_words(words)), text[:40]
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
        assert r.kept == (not r.failed_rules)
    assert quality_rules.verdicts(docs.limit(0)).count() == 0


def test_rules_keep_prose_and_drop_junk(spark):
    prose = " ".join(f"the word{i} of a line{i * 7} and more{i * 3}" for i in range(40))
    junk = [" | ".join(f"cell{i}" for i in range(80)), " ".join(f"THE WORD{i}!! OF" for i in range(60)), " ".join(f"the{i}### of$$$" for i in range(60))]
    docs = spark.createDataFrame([(0, prose), *enumerate(junk, 1)], "doc_id long, text string")
    assert [r.kept for r in quality_rules.verdicts(docs).orderBy("doc_id").collect()] == [True, False, False, False]


def test_license_scan(spark):
    rows = [
        (1, "Foo. ALL RIGHTS\nreserved, cc-by cc by CC"), (2, None), (3, ""), (None, "general public license"), (1, "all rights reserved"), (4, "rights reserved all"),
        (5, "Permission is hereby granted, free of any charge, to any person obtaining a copy"), (6, "GNU General-Public-License! general public"), (7, "Licensed under CC BY-NC"),
        (1, "all rights reserved"), (8, "cc by " * 9000),
    ]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, score int, other string")
    out = license_scan.scan(spark, docs).collect()
    assert len(out) == len(rows) and "text" not in out[0].asDict()
    base = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    wanted = []
    for k, text in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
        at = [(i, label) for phrase, label in base.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        places = [i for i, _ in at]
        wanted.append((str(k), len(words), len(at), str(min(places, default=None)), str(max(places, default=None)), ",".join(sorted({x for _, x in at}))))
    assert sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in out) == sorted(wanted)
    labels = {r.doc_id: r.labels for r in out if r.doc_id in (5, 7)}
    assert labels == {5: "mit", 7: "cc-by,cc-by-nc"}
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in out)
    assert license_scan.scan(spark, docs.limit(0)).count() == 0


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    open_, total = set(names), 1.5 * sum(sizes.values())
    while True:
        level = (total - sum(2 * sizes[s] for s in names if s not in open_)) / (sum(weights[s] for s in open_) or 1)
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not over:
            return {s: level * weights[s] if s in open_ else 2 * sizes[s] for s in names}
        open_ -= over


def test_mixing(spark):
    rows = [(i, ("b", "a", None, "é", "a")[i % 5], "w " * (i % 7 * 10)) for i in range(200)] + [(0, "b", None), (None, "z", "one two"), (3, "é", "w " * 30), (3, "é", "w " * 30)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, source string, text string, target string")
    out = mixing.training_order(mixing.curriculum(docs, buckets=8)).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    assert len(out) == len(rows)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    first = [r.position for r in out if r.position is not None]
    assert first == sorted(first)
    again = mixing.training_order(mixing.curriculum(docs.repartition(5), buckets=8)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    passes = mixing.curriculum(docs, buckets=8, passes=True).collect()
    assert sum(r.pass_words for r in passes) == sum(r.taken for r in out) and passes[0].text is not None
    assert mixing.curriculum(docs.limit(0)).count() == 0 and mixing.curriculum(docs.limit(0), passes=True).count() == 0


@pytest.mark.parametrize("knots", mixing.SCHEDULES)
def test_schedule_inverts_its_integral(spark, knots):
    shares = [i / 10 for i in range(11)]
    times = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.inverted(F.col("s"), knots)).collect()]
    for share, time in zip(shares, times):
        start, weight, slope, used = [x for x in mixing.integrated(knots) if x[0] <= time][-1]
        assert abs(used + weight * (time - start) + slope * (time - start) ** 2 / 2 - share) < 1e-9


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours(spark, n, bits):
    cells = spark.range(2 ** (n * bits)).select(*[(F.floor(F.col("id") / 2 ** (bits * i)) % 2**bits).alias(f"a{i}") for i in range(n)])
    rows = cells.select("*", hilbert_shards.hilbert_index([F.col(f"a{i}") for i in range(n)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(2 ** (n * bits)))
    assert all(sum(abs(a[i] - b[i]) for i in range(n)) == 1 for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("count", [0, 3, 8, 101])
def test_shards(spark, count, tmp_path):
    rows = [(i if i % 9 else None, None if i % 5 == 0 else f"text {i % 4}", f"s{i % 3}" if i % 4 else None, "en", "clash") for i in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard string")
    out = hilbert_shards.shards(docs, buckets=4).collect()
    assert len(out) == count
    per = {}
    for r in out:
        per.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    sizes = [len(per.get(s, [])) for s in range(8)]
    assert sum(sizes) == count and max(sizes) - min(sizes) <= 1
    assert sorted((r["size"], r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    cells = [r.cell for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert cells == sorted(cells)
    if count == 101:
        hilbert_shards.write_shards(hilbert_shards.shards(docs, keep_text=True), str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == count
