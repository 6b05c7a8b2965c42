"""Spans of personal data against Python's regular expressions, and the estimation against plain sums."""

import hashlib
import random
import re

import pytest

from lexframe.llm import personal_data, queries

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        odd, even = number[-1::-2], number[-2::-2]
        return 13 <= len(number) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0
    return kind != "phone" or 9 <= len(number) <= 15


def brute(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if good(k, m[0])] for k, p in PLAIN.items()}


def check(rows, out):
    got = {r.doc_id: r for r in out}
    assert len(got) == len(rows) == len(out)
    for key, text in rows:
        wanted, row = brute(text), got[key]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(x) for x in wanted.values()], text
        base = [f"{k}:{a}:{b}" for k, spans in wanted.items() for a, b in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = [s for s in row.spans.split(",") if s]
        assert set(base) <= set(spans) and len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda s: (personal_data.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


CARD = "4111 1111 1111 1111"
TEXTS = [
    None, "", " ", "a@b.c_d@e.f", "x@y@z.w", "a@b.c.", "a@b..c", "é@b.c ünder@x-y.de", "%+-@1.2", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0255.9", "1.2.3.x.4.5.6.7",
    CARD, CARD + " 5", "4111-1111-1111-1111", "4111  1111 1111 1111", "1 2", "1", "00000000000000", "+1 (743) 555-3824", "+1 2", "+12", "++49 30 1234567.", "+1 (2) 3) (", "+123456789012345678",
    "mail 😀 a@b.de 😀 1.2.3.4, call +1 (743) 555-3824; card 4111111111111111\nx@y.z", "1.2.3.4 5.6.7.8-1.2.3.4", "12 34 56 78 90 12 34 56", "a@b.c@d.e", "@a.b", "1..2.3.4.5",
]


def test_base_spans(spark):
    rows = list(enumerate(TEXTS))
    rng = random.Random(5)
    for i in range(1500):
        rows.append((100 + i, "".join(rng.choice(["a", "Z", "@", ".", "-", " ", "+", "1", "23", "4111", "(", ")", "_", "%", "é", "😀", "\n", CARD, "9.9.9.9"]) for _ in range(rng.randint(1, 25)))))
    found, _ = personal_data.find(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    check(rows, found.collect())


def long_texts(n):
    return [(1, "a" * n + "@"), (2, "1" * n), (3, "1." * (n // 2)), (4, "a@" + "b." * (n // 3)), (5, "+1" + "(" * n), (6, "x@y.z 1.2.3.4 " * (n // 14)), (7, "1 " * (n // 2))]


def test_long_texts(spark):
    rows = long_texts(3000)
    check(rows, personal_data.find(spark, spark.createDataFrame(rows, "doc_id long, text string"))[0].collect())


def test_very_long_texts(spark):
    out = personal_data.find(spark, spark.createDataFrame(long_texts(300_000), "doc_id long, text string"))[0].collect()
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in out}
    assert got == {1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (0, 37_500, 0, 0), 4: (1, 0, 0, 0), 5: (0, 0, 0, 0), 6: (21_428, 21_428, 0, 0), 7: (0, 0, 0, 0)}
    last = next(r for r in out if r.doc_id == 6).spans.split(",")[-1]
    assert last == f"ip:{14 * 21_427 + 6}:{14 * 21_427 + 13}"


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, queries.QUERIES["op12_personal_data"](spark, SF).collect())


def test_method_adds_credentials_and_leaves_prose(spark):
    rows = [(i, f'some words token = "{i:x}9f0e8d7c6b5a4f3e2d1c0{i:x}" and more') for i in range(40)]
    rows += [(100 + i, f"mail{i}@host.org then 10.0.{i}.7") for i in range(40)]
    rows += [(200 + i, f"version 1.{i}.3.999 of page {i}, order 12{i}4567890123456 in section = {i}") for i in range(40)]
    found, judge = personal_data.find(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r.doc_id: r.spans for r in found.collect()}
    texts = dict(rows)
    for i in range(40):
        kind, start, stop = spans[i].split(":")
        assert kind == "secret" and texts[i][int(start) : int(stop)] == texts[i].split('"')[1]
        assert spans[100 + i].count(":") == 4
    assert not any("secret" in s or "ip" in s for k, s in spans.items() if k >= 200)
    assert all(0 < a < 1 and 0 < b < 1 for a, b in judge.reliability)


def test_empty_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "a@b.de", "k", 1, 2, 3), (1, None, "k", 1, 2, 3), (1, None, "k", 1, 2, 3)], "doc_id long, text string, email string, row int, n_ip int, `a``b` int")
    found, _ = personal_data.find(spark, df)
    out = found.collect()
    assert found.columns == ["doc_id", "email", "row", "a`b", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted((r.doc_id is None, r.n_email, r.email, r.row, r["a`b"]) for r in out) == [(False, 0, "k", 1, 3), (False, 0, "k", 1, 3), (True, 1, "k", 1, 3)]
    assert personal_data.find(spark, df.limit(0))[0].count() == 0


def test_compiled_judge_scores_as_the_model(spark):
    counts = {("secret", 3**i + 7 * i): 5 + i for i in range(5)} | {("local", 300 + i): 3 for i in range(4)} | {("email", 1): 9, ("email", 2): 4}
    judge = personal_data.learn(counts)
    rows = [(k, c) for k, c in counts]
    df = spark.createDataFrame(rows, "kind string, code int")
    for kind in ("secret", "local", "email"):
        got = {r.code: r.ok for r in df.where(f"kind = '{kind}'").select("code", judge.accepts(kind, df["code"]).alias("ok")).collect()}
        assert got == {c: judge.score(kind, c) > 0 for k, c in counts if k == kind}


def test_reliable_labelers_are_found():
    """Votes drawn with known rates for two classes: the estimates come near, and classes are told apart."""
    rng = random.Random(7)
    rates = [0.95, 0.9, 0.6, 0.85, 0.7]
    counts, truth = {}, {}
    for _ in range(20000):
        real = rng.random() < 0.5
        code = sum((1 if (rng.random() < r) == real else 2) * 3**i for i, r in enumerate(rates))
        counts[("secret", code)] = counts.get(("secret", code), 0) + 1
        truth.setdefault(code, []).append(real)
    belief, shares = personal_data.reliabilities(counts)
    for r, labeler in zip(rates, shares, strict=True):
        assert labeler[1][1] == pytest.approx(r, abs=0.03) and labeler[0][2] == pytest.approx(r, abs=0.03)
    right = sum((belief[("secret", c)] > 0.5) == t for c, ts in truth.items() for t in ts)
    assert right > 0.95 * 20000
