"""Readers, verified writes, layout, comparison and planning on small fixtures."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lexframe.operators import audit, guards, layout, publish, search
from lexframe.sources import payload, readers


def _file(text, encoding="utf-8"):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    with open(f"{folder}/x.txt", "wb") as out:
        out.write(text.encode(encoding))
    return f"{folder}/x.txt"


def test_wordlists(spark):
    good = _file("﻿lemma,rank,SFI\r\n## note\r\nAbsence,12,53.2\r\n,,\r\nCafé,3,#N/A\r\n")
    rows = {r.word: (r.rank, r.sfi) for r in readers.read_wordlist(spark, good, "ngsl").collect()}
    assert rows == {"absence": (12, 53.2), "café": (3, None)}
    old = _file("word,rank\ncafé ’s,3\n", "cp1252")
    assert [r.word for r in readers.read_wordlist(spark, old, "tsl").collect()] == ["café ’s"]
    with pytest.raises(Exception, match="headword column"):
        readers.read_wordlist(spark, _file("x,1\n"), "ngsl").collect()
    words = readers.read_wordlist(spark, good, "ngsl")
    fam = readers.read_families(spark, _file("absence,absences\n\n"))
    assert {r.word: r.family for r in readers.with_families(words, fam).collect()} == {"absence": ["absence", "absences"], "café": ["Café"]}


def test_dictionary_and_lists(spark):
    xml = "<JMdict>\n<entry><k_ele><keb>上手</keb></k_ele><r_ele><reb>じょうず</reb></r_ele><r_ele><reb>うわて</reb></r_ele><pos>&adj-na; noun</pos></entry>\n<entry><r_ele><reb>から</reb></r_ele><pos>&prt; particle</pos></entry></JMdict>"
    d = readers.read_dictionary(spark, _file(xml))
    assert [(r.surface, r.reading) for r in d.orderBy("reading_ord").collect()] == [("上手", "じょうず"), ("上手", "うわて"), ("から", "から")]
    assert {(r.word, r.plane) for r in readers.lexicon(d).collect()} == {("上手", "written"), ("じょうず", "spoken"), ("うわて", "spoken")}
    f = readers.read_frequency(spark, _file("rank\tlemma\tlForm\tfrequency\n1\t上手\tジョウズ\t10\n2\t\tx\t5\n3\ty\tz\tn/a\n"))
    assert [tuple(r) for r in f.collect()] == [("上手", "ジョウズ", 10)]
    p = readers.read_char_props(spark, _file("# c\nU+4E9C\tkHangul\t아:0E 압\nU+20B9F\tkJapaneseOn\tSHITSU\n"), ["kHangul", "kJapaneseOn"])
    assert {tuple(r) for r in p.collect()} == {("亜", "kHangul", "아"), ("亜", "kHangul", "압"), ("\U00020B9F", "kJapaneseOn", "SHITSU")}
    items, wrong = readers.read_sections(spark, _file("1학년\n한자 (2자)\n一 右\n\n2학년\n한자 (3자)\n引 羽\n"))
    assert {(r.section, r.value) for r in items.collect()} == {("1", "一"), ("1", "右"), ("2", "引"), ("2", "羽")}
    assert [(r.section, r.declared, r.found) for r in wrong.collect()] == [("2", 3, 2)]


def test_gloss_cells(spark):
    df = spark.createDataFrame([("올/바를 정|(漢) 뜻:;",), ("a/b",)], "c string")
    assert [r[0] for r in df.select(readers.multi_gloss(F.col("c"))).collect()] == [["올 정", "바를 정", "뜻"], ["a/b"]]


def test_verified_write(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    df = spark.range(5).withColumnRenamed("id", "key")
    assert payload.write_verified(df, f"{folder}/out") == 5
    with pytest.raises(ValueError):
        payload.write_verified(df, f"{folder}/out", base=f"{folder}/out")
    bad = lambda rows: guards.validate(rows, ["key"], [("small", F.col("key") < 2, F.lit("key"))])
    with pytest.raises(ValueError):
        payload.write_verified(df.where("key < 3"), f"{folder}/out", bad)
    assert spark.read.parquet(f"{folder}/out").count() == 5


def test_anchor_lines(spark):
    df = spark.createDataFrame([(1, y) for y in (1.0, 4.0, 7.0, 9.5, 20.0)], "page int, y double")
    got = {r.y: r.line_y for r in layout.cluster_lines(df, ["page"], "y", 5).collect()}
    assert got == {1.0: 1.0, 4.0: 1.0, 7.0: 7.0, 9.5: 7.0, 20.0: 20.0}


def test_compare_pairs(spark):
    rows = [
        ("a", 1, "소리", ""), ("a", 2, "소리", ""), ("b", 1, "소리, 음", ""), ("b", 2, "소리·음", ""), ("c", 1, "소리\n음색", ""), ("c", 2, "소리\n울림", ""),
        ("d", 1, "가다", "x"), ("d", 2, "가다", "y"), ("e", 1, "가다", ""), ("e", 2, "오다 멀리", ""), ("f", 1, "xyz", ""), ("f", 2, "abcdefghij", ""), ("f", 3, "abcdefghi", ""),
    ]
    df = spark.createDataFrame(rows, "g string, ord int, meaning string, why string")
    got = {r.g: (r.a, r.b, r.severity) for r in audit.compare_pairs(df, ["g"]).collect()}
    assert got == {"a": (1, 2, "FAIL"), "b": (1, 2, "FAIL"), "c": (1, 2, "WARN"), "d": (1, 2, "WARN"), "f": (2, 3, "WARN")}


def test_search_ranks(spark):
    terms = spark.createDataFrame([
        ("亜", 0, "亜", "key", "", 5), ("亜", 1, "亞", "variant", "", 5), ("生", 0, "生", "key", "", 9), ("生", 1, "弥生", "word", "", 9), ("弥", 0, "弥", "key", "", 3), ("弥", 1, "弥生", "word", "", 3),
    ], "key string, ord int, text string, kind string, context string, weight long")
    queries = spark.createDataFrame([("1", "亞"), ("2", "弥生"), ("3", " "), ("4", "生")], "qid string, query string")
    got = {}
    for r in search.search(terms, queries, search.KANJI_RANKS).orderBy("qid", "place").collect():
        got.setdefault(r.qid, []).append((r.key, r.match_kind, r.exact, r.total))
    assert got == {"1": [("亜", "variant", True, 1)], "2": [("生", "word", True, 2), ("弥", "word", True, 2)], "4": [("生", "key", True, 2), ("弥", "word", False, 2)]}


def test_packing(spark):
    df = spark.createDataFrame([("亜", "값")], "key string, tag string")
    packed = publish.pack_records(df, ["tag"])
    text = packed.first().Data
    assert text.isascii() and text == publish.pack_records(df, ["tag"]).first().Data
    back = packed.select(publish.unpack(F.concat(F.lit(" \n"), "Data"), "struct<key:string,record:struct<tag:string>>").alias("b")).first().b
    assert (back.key, back.record.tag) == ("亜", "값")


def test_headers_go_by_place(spark):
    listed = _file("word,rank\nthe,1\nword,2\nlemma,3\ncat,4\n")
    assert sorted(r.word for r in readers.read_wordlist(spark, listed, "ngsl").collect()) == ["cat", "lemma", "the", "word"]
    with pytest.raises(Exception, match="not a rank"):
        readers.read_wordlist(spark, _file("word,rank\nthe,first\n"), "ngsl").collect()
    with pytest.raises(Exception, match="two lines"):
        readers.read_families(spark, _file("be,am\nBe,is\n")).collect()


def test_search_folds_case(spark):
    terms = spark.createDataFrame([("a", 0, "straße", "key", "", 1), ("b", 0, "street", "key", "", 1)], "key string, ord int, text string, kind string, context string, weight int")
    asked = spark.createDataFrame([("q", "STRASSE")], "qid string, query string")
    assert [r.key for r in search.search(terms, asked, {"key": 0}).collect()] == ["a"]


def test_long_words_are_found(spark):
    from lexframe.operators import verify

    lexicon = spark.createDataFrame([("thirteenchars",), ("ab",)], "word string")
    rows = spark.createDataFrame([(1, "xxthirteencharsab")], "id int, text string")
    assert sorted((r.start, r.stop) for r in verify.lexicon_spots(rows, ["id"], "text", lexicon).collect()) == [(2, 15), (15, 17)]
    spans = spark.createDataFrame([(1, "xxthirteenchars", 4, 6)], "id int, text string, start int, stop int")
    assert [r.cut for r in verify.cut_by_word(spans, ["id"], "text", lexicon).collect()] == [True]


def test_sections_sort_their_lines_once(spark):
    """Number and name of a section come from one window over the lines; a section may span buckets."""
    lines = ["x", "1학년", "(3자)", "a b", " \t", "c", "2학년", "(1자)", "d e"]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)], "file string, n long, text string")
    items, wrong = readers.parse_sections(df, ["file"], ["n"], F.floor(F.col("n") / 2), r"^(\d)학년$", r"\((\d+)자\)")
    assert sorted((r.section_no, r.section, r.value) for r in items.collect()) == [(1, "1", "a"), (1, "1", "b"), (1, "1", "c"), (2, "2", "d"), (2, "2", "e")]
    assert [(r.section_no, r.declared, r.found) for r in wrong.collect()] == [(2, 1, 2)]
    assert items._jdf.queryExecution().optimizedPlan().toString().count("Window [") <= 2
