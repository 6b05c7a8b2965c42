"""Alignment, verification, attribution, selection, notes: documented cases."""

from pyspark.sql import functions as F

from lexframe.operators import align as A, attribute as T, notes as N, select as S, verify as V

DICT = [
    ("搭乗", "とうじょう", 0), ("取締役会", "とりしまりやくかい", 0), ("掲示板", "けいじばん", 0), ("上手", "じょうず", 0), ("上手", "うわて", 1), ("格上", "かくうえ", 0),
    ("格上げ", "かくあげ", 0), ("会社", "かいしゃ", 0), ("見込む", "みこむ", 0), ("支払う", "しはらう", 0), ("音楽", "おんがく", 0), ("流れる", "ながれる", 0), ("提供", "ていきょう", 0),
]


def _dict(spark):
    return spark.createDataFrame(DICT, "surface string, reading string, reading_ord int")


def test_alignment(spark):
    cases = [
        ("搭乗する", "とうじょうする", ["搭乗(とうじょう)する"]), ("払い戻す", "はらいもどす", ["払(はら)い戻(もど)す"]), ("お知らせ", "おしらせ", ["お知(し)らせ"]),
        ("チャージ", "チャージ", ["チャージ"]), ("搭乗する", "とうじょうしない", []), ("一羽（わ）", "いちわ", []), ("空き状況", "あきじょうきょう", ["空(あ)き状況(じょうきょう)"]),
        ("音楽が流れ", "おんがくがながれ", ["音楽(おん)が流(くがなが)れ", "音楽(おんがく)が流(なが)れ"]), ("真っ青", "まっさお", ["真(ま)っ青(さお)"]), ("", "あ", []),
    ]
    df = spark.createDataFrame([(i, s, r) for i, (s, r, _) in enumerate(cases)], "i int, surface string, reading string")
    got = {r.i: r.a for r in df.select("i", A.alignments(F.col("surface"), F.col("reading")).alias("a")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]
    only = {r.i: r.a for r in df.select("i", A.align_unique(F.col("surface"), F.col("reading")).alias("a")).collect()}
    assert only[7] is None and only[0] == "搭乗(とうじょう)する"
    # the SQL table function gives the same candidates
    A.register_sql(spark)
    df.createOrReplaceTempView("align_in")
    rows = spark.sql("select i, a.candidate from align_in, lateral align(surface, reading) a").collect()
    table = {}
    for r in rows:
        table.setdefault(r.i, set()).add(r.candidate)
    assert table == {i: set(a) for i, a in got.items() if a}


def test_verification(spark):
    rows = spark.createDataFrame([
        ("取締役会", "とりしまりやくかい"), ("搭乗する", "とうじょうする"), ("掲示板", "けいしばん"), ("していただけませんか", "していただけませんか"), ("上手に", "うわてに"), ("上手に", "かみてに"),
    ], "surface string, kana string")
    got = {(r.surface, r.kana): (r.grade, r.reading) for r in V.verify_readings(rows.union(rows), _dict(spark)).collect()}
    assert got[("取締役会", "とりしまりやくかい")][0] == "jmdict" and got[("搭乗する", "とうじょうする")][0] == "jmdict"
    assert got[("掲示板", "けいしばん")] == ("unsure", "けいじばん")
    assert got[("していただけませんか", "していただけませんか")][0] == "phrase"
    assert got[("上手に", "うわてに")][0] == "jmdict" and got[("上手に", "かみてに")] == ("unsure", "うわてに")


def test_fits_and_choice(spark):
    fits = V.fit_table(_dict(spark))
    rows = spark.createDataFrame([
        (1, "格上(かくあ)げする"), (2, "会社(がいしゃ)を"), (3, "見込(みこ)んでいます"), (4, "提供(つていきょう)する"), (5, "支払(しはら)われる"), (6, "未知(みち)の")], "i int, a string")
    got = {r.i: r.fits_long for r in V.readings_fit(rows, ["i"], "a", fits).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: True, 6: True}
    pairs = spark.createDataFrame([
        (1, "Music plays.", "音楽が流れています", "おんがくがながれています", "noun", "音楽", ["music"]), (2, "x", "音楽", "おんがく", "noun", "音楽", ["music"]),
        (3, "Music!", "会社", "かいしゃ", "noun", "音楽", ["music"]), (4, "music", "会社", "かいしゃ", "function", "音楽", ["music"]), (5, "", "会社", "かいしゃ", "noun", "会社", ["a"]),
        (6, "music", "提供", "つていきょう", "noun", "提供", ["music"]), (7, "music", "会社", "しゃかい で", "noun", "会社", ["music"]),
    ], "i int, en string, ja string, kana string, pos string, gloss_ja string, family array<string>")
    out = {r.i: (r.written, r.reason) for r in V.check_pairs(pairs, ["i"], fits).collect()}
    assert out[1] == ("音楽(おんがく)が流(なが)れています", None)
    assert out[2][1] == "word missing in English" and out[3][1] == "sense missing in Japanese" and out[4] == ("会社(かいしゃ)", None)
    assert out[5][1] == "empty answer" and out[6][1] == "reading differs from the dictionary" and out[7][1] == "reading does not align"


REGULAR = {
    "手": "シュ て た", "下": "カ ゲ した しも もと さー くだー おー", "今": "コン キン いま", "年": "ネン とし", "日": "ニチ ジツ ひ か", "川": "セン かわ", "原": "ゲン はら", "巡": "ジュン めぐー",
    "早": "ソウ はやー", "乙": "オツ", "女": "ジョ おんな め", "立": "リツ たー", "退": "タイ しりぞー", "笑": "ショウ わらー えー", "顔": "ガン かお", "伝": "デン つたー",
}


def test_irregular(spark):
    readings = spark.createDataFrame([(c, k) for c, ks in REGULAR.items() for k in ks.split()], "ch string, key string")
    cases = {
        ("下手", "へた"): ["下"], ("手伝う", "てつだう"): ["伝"], ("立ち退く", "たちのく"): ["退"], ("お巡りさん", "おまわりさん"): ["巡"], ("今日", "きょう"): ["今", "日"],
        ("笑顔", "えがお"): ["笑", "顔"], ("早乙女", "さおとめ"): ["早", "乙"], ("浮気", "うわき"): ["浮"],
    }
    entries = spark.createDataFrame(list(cases) + [("手話", "て")], "surface string, reading string")
    fixed = spark.createDataFrame([(r, s, c) for r, s, c in T.ADJUDICATED], "reading string, surface string, ch string")
    rows = T.attribute_irregular(entries, T.regular_readings(readings), fixed.where("surface = '浮気'")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.ord if r.ord is not None else -1):
        got.setdefault((r.surface, r.reading), []).append(r.ch if r.reason is None else r.reason)
    assert got.pop(("手話", "て")) == ["no split"]
    assert got == cases


def test_inflection(spark):
    rows = [
        ("生", "いきる", 1, "生きる"), ("生", "いきる", 2, "長生き"), ("生", "おう", 1, "生い立ち"), ("生", "おう", 2, "生い茂る"), ("位", "くらい", 1, "位"), ("三", "みつ", 1, "三つ指"),
        ("互", "たがい", 1, "互い"), ("干", "ひる", 1, "干物"), ("干", "ひる", 1001, "干る"), ("足", "たる", 1, "舌足らず"), ("足", "たる", 1001, "足る"), ("円", "エン", 1, "円"),
    ]
    df = spark.createDataFrame(rows, "ch string, reading string, ord int, example string")
    got = {(r.ch, r.reading): (r.key, r.method) for r in S.infer_reading_key(df).collect()}
    assert got == {
        ("生", "いきる"): ("いー", "surface"), ("生", "おう"): ("おー", "renyo"), ("位", "くらい"): ("くらい", "uninflected"), ("三", "みつ"): ("みつ", "plain"),
        ("互", "たがい"): ("たがい", "plain"), ("干", "ひる"): ("ひー", "surface"), ("足", "たる"): ("たー", "surface"), ("円", "エン"): ("エン", "plain")}


def test_notes(spark):
    rows = [
        ("春", "はる", "「春雨」，「小雨」，「霧雨」などは，「はるさめ」，「こさめ」，「きりさめ」。"), ("主", "シュ", "「法主（ホッス）」は，「ホウシュ」，「ホッシュ」とも。"), ("猫", "ビョウ", "「山頂」の意。"),
        ("下", "もと", "⇔元，本，基"), ("上", "ジョウ", "上手（じょうず）下手（へた）"), ("餌", "え", "［餌］＝許容字体"), ("岡", "おか", "岡山県，静岡県，福岡県"), ("交", "まー", "「まぜる」とも。"), ("謎", "なぞ", "なにかの説明。"),
    ]
    df = spark.createDataFrame(rows, "ch string, reading0 string, note string")
    got = {}
    for r in sorted(N.classify_notes(df.withColumnRenamed("ch", "id").withColumn("ch", F.col("id")), ["id"], "ch", "reading0", "note").collect(), key=lambda r: r.ord):
        got.setdefault(r.id, []).append((r.kind, r.word, r.reading, r.words))
    assert [x[:3] for x in got["春"]] == [("special_reading", "春雨", "はるさめ"), ("special_reading", "小雨", "こさめ"), ("special_reading", "霧雨", "きりさめ")]
    assert [x[:3] for x in got["主"]] == [("also_read", "法主", "ホウシュ"), ("also_read", "法主", "ホッシュ")]
    assert got["下"] == [("same_kun", None, None, ["元", "本", "基"])] and got["猫"][0][0] == "text" and got["交"][0][:3] == ("also_reading", None, "まぜる")
    assert got["謎"][0][0] == "reject" and not {"上", "餌", "岡"} & set(got)
    stripped = spark.createDataFrame([("上手（じょうず）下手（へた）",), ("固唾（かたず）⇔堅い，硬い",), ("岡山県，静岡県，福岡県",)], "n string")
    assert [r[0] for r in stripped.select(N.strip_references(F.col("n"))).collect()] == ["", "⇔堅い，硬い", "岡山県，静岡県，福岡県"]


def test_residuals_and_rekey(spark):
    readings = spark.createDataFrame([("棺", "かん"), ("物", "ぶつ"), ("物", "もの")], "ch string, reading string")
    words = spark.createDataFrame([("甕棺", "かめかん"), ("甕物", "かめもの")], "w string, known string").withColumn("ch", F.lit("甕"))
    got = {r.w: r.residual for r in S.unique_residual(words, ["ch", "w", "known"], "w", "known", "ch", S.all_sound_forms(readings)).collect()}
    assert got == {"甕棺": "かめ", "甕物": "かめ"}
    df = spark.createDataFrame([("鵜", "テイ", 1, "鵜"), ("蕎", "キョウ", 1, "蕎麦"), ("甕", "オウ", 1, "甕棺"), ("巫", "ブ", 1, "巫覡"), ("珈", "カ", 1, "珈琲")], "ch string, reading string, ord int, w string")
    dic = spark.createDataFrame([("鵜", "う", 0), ("蕎麦", "そば", 0), ("甕棺", "かめかん", 0), ("巫覡", "ふげき", 0)], "surface string, reading string, reading_ord int")
    on = spark.createDataFrame([("鵜", "TEI")], "ch string, value string")
    out = {r.ch: (r.bucket, r.key) for r in S.rekey_examples(df, dic, readings, on).collect()}
    # 蕎 keeps no reading of its own, so the exception comes back as its reading
    assert out == {"鵜": ("readings", "う"), "蕎": ("readings", "そば"), "甕": ("readings", "かめ"), "巫": ("readings", "ブ"), "珈": ("readings", "カ")}


def test_failing_enrichment_says_so(spark):
    from lexframe.operators import ledger

    asked = spark.createDataFrame([(1, "good"), (2, "bad")], "batch long, body string")

    def answer(body):
        if body == "bad":
            raise ValueError("no answer")
        return ""

    got = {r.batch: (r.response, r.error) for r in ledger.enrich(asked, answer).collect()}
    assert got == {1: ("", None), 2: (None, "ValueError: no answer")}


def test_residual_is_worked_out_once_per_word(spark, monkeypatch):
    """A word with several targets and forms has one residual per reading, which all of them share."""
    asked, plain = [], S.best_residual
    monkeypatch.setattr(S, "best_residual", lambda df, *a: asked.append(df.count()) or plain(df, *a))
    freq = spark.createDataFrame([("部科木", "ぶかき", 9), ("部科木", "ぶかぎ", 4), ("木あ", "きあ", 2)], "lemma string, form string, freq long")
    dictionary = spark.createDataFrame([("部科木", "ぶかき", 0)], "surface string, reading string, reading_ord long")
    readings = spark.createDataFrame([("科", "か")], "ch string, reading string")
    targets, official = spark.createDataFrame([("部",), ("木",), ("科",)], "ch string"), spark.createDataFrame([("科", "カ")], "ch string, key string")
    rows = sorted(tuple(r) for r in S.select_examples(freq, dictionary, readings, targets, official).select("ch", "reading", "place", "lemma", "freq").collect())
    assert asked == [2]
    assert rows == [("木", "き", 2, "木あ", 2), ("木", "ぶかき", 1, "部科木", 9), ("科", "カ", 1, None, None), ("部", "ぶかき", 1, "部科木", 9)]
