from pyspark.sql import functions as F

from lexframe.functions import text as X
from lexframe.operators import marking as M

LEXICON = [("冷たい", "written"), ("つめたい", "spoken")]
ROWS = [
    # (ja, head, connect, marked, method)
    ("愛(あい)あっての結(けっ)婚(こん)", "あっての", [], "愛(あい)*あっての*結(けっ)婚(こん)", "exact/plain"),
    ("夏(なつ)の間(あいだ)", "あいだ", [], "夏(なつ)の*間(あいだ)*", "exact/reading"),
    ("予想(よそう)以上(いじょう)は", "いじょう（は）", [], "予想(よそう)*以上(いじょう)は*", "exact/reading"),
    ("あまりの寒(さむ)さに", "あまりの～に", [], "*あまりの*寒(さむ)さ*に*", "exact/plain"),
    ("読(よ)んだり、見(み)たりします", "たり～たりする", [], "読(よ)ん*だり*、見(み)*たりします*", "inflected/plain"),
    ("読(よ)んだり、見(み)たりです", "たり～たりする", [], "読(よ)ん*だり*、見(み)*たり*です", "repeat/plain"),
    ("冷(つめ)たいビールが飲(の)みたい", "たい", ["Ｖます ＋ たい"], None, None),
    ("冷たいビールが飲みたい", "たい", ["Ｖます ＋ たい"], "冷たいビールが飲み*たい*", "exact/plain"),
    ("まったく関係(かんけい)ない", "ぜんぜん", [], None, None),
]


def test_mark_patterns(spark):
    df = spark.createDataFrame([(i, a, h, c) for i, (a, h, c, _m, _w) in enumerate(ROWS)], "id int, ja string, head string, connect array<string>")
    lexicon = spark.createDataFrame(LEXICON, "word string, plane string")
    got = {r.id: (r.marked, r.mark_method) for r in M.mark_patterns(df, ["id"], lexicon).collect()}
    for i, (a, h, _c, marked, method) in enumerate(ROWS):
        if h == "たい" and "(" in a:
            continue
        assert got[i] == (marked, method), (a, h, got[i])
    # the annotated one: 冷たい is a word, so the later たい wins
    assert got[6] == ("冷(つめ)たいビールが飲(の)み*たい*", "exact/plain")


def test_forms(spark):
    df = spark.createDataFrame([("たり～たりする",), ("お～・ご～",), ("あまりの～に",), ("たら～（のに）",), ("",)], "h string")
    got = [r[0] for r in df.select(M.head_forms(F.col("h"))).collect()]
    assert got == [[["たり", "たりする"], ["たりする"]], [["お"], ["ご"]], [["あまりの", "に"]], [["たら"]], []]
    rows = spark.createDataFrame([
        (["Ｖて ＋ くる  Ｖて ＋ いく"], [["てくる"]]), (["Ｖる＋こと／Ｎ ＋ ができる"], []), (["Ｎ（ナＡな／Ｎな）＋ の"], []), (["Ｖると ＋ ～た  Ｖたら ＋ ～た"], [["と", "た"]]),
    ], "c array<string>, k array<array<string>>")
    got = [r[0] for r in rows.select(M.connect_forms(F.col("c"), F.col("k"))).collect()]
    assert got[0] == [["ていく"]]
    assert ["ことができる"] in got[1]
    assert got[2] == []
    assert got[3] == [["たら", "た"]]


def test_connections_and_pieces(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, plane string")
    df = spark.createDataFrame([(1, "増(ふ)えていきます", "てくる", ["Ｖて ＋ くる  Ｖて ＋ いく"])], "id int, ja string, head string, connect array<string>")
    row = M.mark_from_connections(df, ["id"], lexicon).collect()[0]
    assert row.mark_method.startswith("connect-inflected") and row.marked == "増(ふ)え*ていきます*"
    pieces = spark.createDataFrame([
        ("本(ほん)を読(よ)んだり、見(み)たりします", ["だり", "たりします"]), ("夏(なつ)の後(あと)で", ["後"]), ("夏(なつ)の後(あと)で", ["後", "夏"]), ("夏(なつ)", [" "]),
    ], "a string, p array<string>")
    got = [r[0] for r in pieces.select(M.mark_with_pieces(F.col("a"), F.col("p"))).collect()]
    assert got == ["本(ほん)を読(よ)ん*だり*、見(み)*たりします*", "夏(なつ)の*後(あと)*で", None, None]


def test_overruns(spark):
    df = spark.createDataFrame([
        ("たり～たりする", ["たり、テレビを見たりします"]), ("たり～たりする", ["たり", "たりします"]), ("くする", ["きれいにしなさい"]), ("", ["x"]),
    ], "h string, s array<string>")
    assert [r[0] for r in df.select(M.overruns(F.col("h"), F.col("s"))).collect()] == [5, 0, 1, 0]


def test_waterfall_and_audit(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, plane string")
    df = spark.createDataFrame([
        (1, "愛(あい)あっての", "あっての", None, None, None),
        (2, "やってみる", "ぜんぜん", None, ["みる"], None),
        (3, "やってみる", "ぜん～ぜん", None, ["やってみるやってみるやってみるやってみる"], None),
        (4, "やってみる", "ぜんぜん", None, None, "って"),
        (5, "増(ふ)えていく", "てくる", ["Ｖて ＋ くる  Ｖて ＋ いく"], None, None),
        (6, "なにもない", "ぜん～ぜん", None, None, "なに"),
    ], "id int, ja string, head string, connect array<string>, pieces array<string>, legacy string")
    got = {r.id: (r.marked, r.mark_method, r.revoked) for r in M.mark_waterfall(df, ["id"], lexicon).collect()}
    assert got[1] == ("愛(あい)*あっての*", "exact/plain", False)
    assert got[2] == ("やって*みる*", "model", False)
    assert got[3] == ("やってみる", None, True)
    assert got[4] == ("や*って*みる", "model", False)
    assert got[5] == ("増(ふ)え*ていく*", "connect-exact/plain", False)
    assert got[6] == ("なにもない", None, False)
    bad = spark.createDataFrame([
        (1, "夏(なつ)の", "*夏*(なつ)の", "model", "あいだ"), (2, "abc", "*a*bc*", None, ""), (3, "abc", "*x*bc", None, ""),
        (4, "冷たいな", "冷*たい*な", "exact/plain", "たい"), (5, "あまりの寒さに", "*あまりの寒さに*", "model", "あまりの～に"), (6, "やる", "*やる*", "exact/plain", "あげる"),
    ], "id int, ja string, marked string, mark_method string, head string")
    found = {(r.id, r.severity, r.reason) for r in M.audit_marks(bad, ["id"], lexicon).collect()}
    assert (1, "FAIL", "mark inside a chunk") in found and (2, "FAIL", "unpaired marks") in found
    assert (3, "FAIL", "text changes without marks") in found and (4, "WARN", "inside a word") in found
    assert (5, "WARN", "one piece of a split pattern") in found and (6, "WARN", "no letters shared with the head") in found


def test_planes_are_the_chunks(spark):
    """A plane is what its chunks say, and is made in one pass over the text."""
    texts = ["部(ぶ)あ", "あ部科(ぶか)い", "部科(ぶか", "(ぶ)部()x", "部(ぶ(か)科(か)", "a(b)c", "々(の)", "", "𠮷(よし)野(の)𝒳", "部\n科(か\nう)", None, "部(a$1\\b)"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for which in ("surface", "sound"):
        told = F.array_join(F.transform(X.chunks(F.col("t")), lambda g: g[which]), "")
        assert rows.where(~told.eqNullSafe(X.plane(F.col("t"), which))).collect() == []
        assert "lambda" not in rows.select(X.plane(F.col("t"), which))._jdf.queryExecution().toString()


def test_spots_need_no_exchange(spark):
    """The places looked up in a bounded lexicon are not dealt out: only what stands there, and the rows, by key."""
    rows = spark.createDataFrame([("a", "部(ぶ)あ部(ぶ)")], "word string, ja string")
    lexicon = spark.createDataFrame([("部あ", "written"), ("ぶあ", "spoken"), ("ぶあぶ", "spoken")], "word string, plane string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = M.with_spots(rows, ["word"], "ja", lexicon)
        assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
        found = out.select(F.sort_array("spots_surface"), F.sort_array("spots_sound")).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [tuple(map(tuple, x)) for x in found] == [((0, 2),), ((0, 2), (0, 3))]
