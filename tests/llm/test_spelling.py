"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest

from lexframe.llm import spelling

TEXT = "doc_id long, text string"


def brute_vocabulary(rows, length=6, occurrences=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= occurrences}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, **options):
    words = brute_vocabulary(rows, **options)
    form, out = {}, []
    near = {w: sorted((v for v in words if is_near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    for w, others in near.items():
        form[w] = others[0] if others and words[others[0]] >= 5 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, TEXT)
    return sorted(tuple(r) for r in spelling.variants(spark, df, **options).collect())


def sample():
    counts = {
        "colour": 200, "color": 300, "colours": 30, "coloour": 5, "kolour": 6, "kolours": 6, "colonr": 7, "zcolour": 5, "colourz": 5, "oclour": 5,
        "aaaaaa": 50, "aaaaaaa": 9, "aaaaaaaa": 5, "aaaaab": 8, "baaaaa": 9, "ababab": 7, "bababa": 7, "abababa": 6, "façade": 40, "facade": 8, "façäde": 5, "Études": 6, "études": 6,
        "abcdef": 1250, "abcdeg": 250, "abcdhg": 50, "abcihg": 10, "abjihg": 5, "short": 90, "rarest": 4, "multi×ply": 6,
    }
    words = [w for w, n in counts.items() for _ in range(n)]
    return [(i, " ".join(words[i::40]).upper() if i % 2 and i < 30 else "-".join(words[i::40])) for i in range(40)]


def test_variants(spark):
    rows = sample() + [(None, None), (50, ""), (None, "colour, colour"), (3, "12 中文 !"), (7, "facade"), (7, "facade")]
    got = found(spark, rows)
    assert got == brute(rows)
    roots = {r[0]: r[2] for r in got}
    assert roots["abjihg"] in ("abcihg", "abjihg") and roots["abcihg"] == "abcdef"


def test_damage_reaches_the_words(spark):
    rows = [(i, "committee quality abcdefg") for i in range(3000)]
    got = found(spark, rows)
    assert got == brute(rows) and len(got) > 3


@pytest.mark.parametrize("lot", [1, 3])
def test_pairs_of_crowded_grams(spark, lot):
    words = [f"prefix{c}{d}" for c in "abcdefgh" for d in "abcdefgh"] + [f"{c}prefix" for c in "abcdefgh"] + ["prefix", "prefixa", "pprefix"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(r) for r in spelling.near_pairs(df, lot=lot).collect()]
    wanted = {frozenset((a, b)) for a in words for b in words if a != b and is_near(a, b)}
    assert len(got) == len(wanted) and {frozenset(p) for p in got} == wanted


def test_empty_long_and_clashing(spark):
    assert found(spark, []) == [] and found(spark, [(1, None), (2, "a b")]) == []
    long = [(1, "letter " * 60000), (2, "a" * 300000), (3, "lettre " * 10)]
    assert found(spark, long) == brute(long)
    df = spark.createDataFrame([(i, "letters apart", "x", 1, "y") for i in range(6)], "doc_id long, text string, word string, n int, `a``b` string")
    assert sorted(tuple(r) for r in spelling.variants(spark, df).collect()) == brute([(i, "letters apart") for i in range(6)])
