from pyspark.sql import functions as F

from lexframe.functions import text as X


def test_folds(one):
    assert one(X.kana_fold, "カーヴァ", "ヶヷ") == ["かーゔぁ", "ゖヷ"]
    assert one(X.kana_unfold, "かゔ") == ["カヴ"]
    assert one(X.reading_norm, "アッパツ", "いのー") == ["あつぱつ", "いの"]


def test_kinds(one):
    assert one(X.reading_kind, "キ", "いのり", "いのー", "カー", "ー", "いーの", "かナカ", "") == [
        "on", "kun", "verb", None, None, None, None, None]
    assert one(X.is_base, "漢々〆\U00020B9F", "あ") == [True, False]


def test_surfaces(one):
    assert one(X.plain_surface, "一(いち)羽（わ）", "漢字(かな", "a(b(c)d") == ["一羽（わ）", "漢字(かな", "ad"]
    assert one(X.word_length, "三日（みっか）", "三日月(みかづき)") == [2, 3]
    assert one(X.reading_length, "空港(くうこう)", "哀(あわ)れむ") == [4, 4]


def test_annotations(one):
    ok = one(X.annotation_ok, "搭乗(とうじょう)する", "一(いち)羽（わ）", "\U00020B9F(しか)る", "漢字", "漢(かx)", "漢(か", "", "かな", "漢()")
    assert ok == [True, True, True, False, False, False, False, True, False]
    assert one(X.generated_reading, "一(いち)羽（わ）", "甘(あま)い") == ["いち", "あまい"]
    assert one(X.full_reading, "一(いち)羽（わ）") == ["いちわ"]
    seg = one(X.segments, "お巡(まわ)りさん（は）")[0]
    assert [tuple(s) for s in seg] == [
        ("お", None, "literal"), ("巡", "まわ", "generated"), ("りさん（は）", None, "literal")]


def test_ruby(one):
    assert one(X.ruby_bracket, "空港(くうこう)", "お巡(まわ)りさん", "離(はな)れ離(ばな)れ", "漢字漢(かん)", "一（いち）") == [
        "空港[くうこう]", "お 巡[まわ]りさん", "離[はな]れ 離[ばな]れ", "漢字漢[かん]", "一（いち）"]
    assert one(X.ruby_html, "a<漢(か)") == ["a&lt;<ruby>漢<rt>か</rt></ruby>"]


def test_senses(one):
    assert one(X.senses, "소리\n 음 \n\n", "a, b") == [["소리", "음"], ["a, b"]]
    assert one(X.has_boundary_semicolon, "일위(하나; 대위)", "a; b", ")a;b", "(a]；") == [False, True, True, False]
    got = one(X.clean_answer, ["소리.", " 음 "], ["a;b"], ["a(b)"], [], ["a", "b", "c", "d"], ["a\nb"], ["."], kind="array<string>")
    assert got == [["소리", "음"], None, None, None, None, None, None]
    rows = one(X.clean_senses, [("空", "そら", "x", "g", "e"), ("", "a", "noun", "", ""), ("行く", "いく", "verb", None, " go ")],
               kind="array<struct<ja:string,kana:string,pos:string,gloss:string,en:string>>")[0]
    assert [tuple(r) for r in rows] == [("空", "そら", "noun", "g", "e"), ("行く", "いく", "verb", "", "go")]


def test_sounds(one):
    assert set(one(X.phonetic_variants, "かつ")[0]) == {"かつ", "がつ", "かっ", "がっ"}
    assert set(one(X.phonetic_variants, "はく")[0]) == {"はく", "ばく", "ぱく", "はっ", "ばっ", "ぱっ"}
    assert one(X.phonetic_variants, "つ")[0] == ["つ", "づ"]
    assert set(one(X.sound_forms, "ブー")[0]) == {"ぶ", "ふ"}
    assert set(one(X.sound_forms, "かつ")[0]) == {"かつ", "がつ", "かっ"}
    assert set(one(X.voiced_forms, "ほん")[0]) == {"ほん", "ぼん", "ぽん"}


def test_romanize(one):
    assert one(X.romanize, "きょう", "はち", "はっち", "しゅっぱつ", "じゃ", "っしゃ") == [
        "KYOU", "HACHI", "HACCHI", "SHUPPATSU", "JA", "SSHA"]


def test_small_forms(one):
    assert one(X.compare_form, "소리, 음", "소리·음（）") == ["소리음", "소리음"]
    assert one(X.search_stem, "〜に違いない", "書く", "のように", "〜の間") == ["違", "書", "のよ", "間"]
    assert one(X.codepoint_label, "亜", "\U00020B9F") == ["U+4E9C", "U+20B9F"]
    assert one(X.nfc_safe, "abc", "\uFA67", "\u00e9") == ["abc", "&#xFA67;", "\u00e9"]
    assert one(X.nfc_safe, "\uFA67x")[0] == "&#xFA67;x"


def test_family(spark):
    df = spark.createDataFrame([("The Absences were noted.", ["absence"]), ("misabsence", ["absence"]), ("a.b", ["a.b"])], "en string, f array<string>")
    assert [r[0] for r in df.select(X.contains_family(F.col("en"), F.col("f"))).collect()] == [True, False, True]


def test_marks(one):
    assert one(X.mark_spans, "本を*だり*、見*たりします*。", "abc", "*a") == [["だり", "たりします"], [], []]
    assert one(X.mark_offsets, "ab*c*d", "abc") == [[2, 3], []]
    got = one(X.chunks, "夏(なつ)の間a")[0]
    assert [tuple(g) for g in got] == [("夏", "なつ", 0, 5), ("の", "の", 5, 6), ("間", "間", 6, 7), ("a", "a", 7, 8)]
    assert one(lambda c: X.plane(c, "sound"), "夏(なつ)の間(あいだ)") == ["なつのあいだ"]
    assert sorted(one(X.chunk_edges, "夏(なつ)の")[0]) == [0, 5, 6]


def test_branches(one):
    got = one(X.branches, "甘(あま)い・甘(あま)やかす", "兄（にい）さん", "漢字", "一羽(いちわ)（わ・ば）")
    assert [(b.surface, b.local, b.reading, b.printed) for b in got[0]] == [
        ("甘い", "あまい", "あまい", False), ("甘やかす", "あまやかす", "あまやかす", False)]
    assert got[1][0].options == ["にいさん", "にい"] and got[1][0].reading == "にいさん"
    assert got[2] is None
    assert got[3][0].options == ["いちわ", "わ・ば"]


def test_half_width_brackets_stand_on_base_runs(one):
    assert one(X.annotation_ok, "かな(かな)", "漢字(かんじ)(x)", "abc(d)", "漢字(かんじ)", "漢字（かんじ）x", "か(な", "漢字(かんじ)を見(み)る") == [False, False, False, True, True, True, True]


def test_case_fold(one):
    assert one(X.case_fold, "STRASSE", "straße", "Σίγμας", "ﬁn") == ["strasse", "strasse", "σίγμασ", "fin"]
