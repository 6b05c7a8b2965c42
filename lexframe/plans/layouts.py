"""Layout reconstruction over tokens positioned by their place in documents, words and turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import layout as L
from lexframe.plans import base as B
from lexframe.session import table

CUTS = [(90.0, "head"), (180.0, "read"), (300.0, "ex")]


def layout_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Columns and anchored lines of every document; per cell the token count and joined text."""
    p = F.col("pos")
    tokens = B.words(spark, sf).select(
        "doc_id", (p % 8 * 45.0).alias("x0"), (F.floor(p / 8) * 4 + p * 13 % 7).cast("long").alias("y"), "pos", "word")
    placed = L.cluster_lines(L.assign_columns(tokens, "x0", CUTS, "note"), ["doc_id"], "y", 5)
    pieces = F.sort_array(F.collect_list(F.struct("x0", "pos", "word")))
    return placed.groupBy("doc_id", "line_y", "col").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.transform(pieces, lambda t: t["word"]), " ").alias("text"))


LINES_ORACLE = f"""WITH RECURSIVE {B.WORDS_SQL},
tok AS (SELECT doc_id, pos, word, (pos % 8) * 45.0 AS x0, (pos // 8) * 4 + (pos * 13) % 7 AS y FROM words),
ys AS (SELECT DISTINCT doc_id, y FROM tok),
anchors AS (
  SELECT doc_id, min(y) AS a FROM ys GROUP BY doc_id
  UNION ALL
  SELECT r.doc_id, min(s.y) FROM anchors r JOIN ys s ON s.doc_id = r.doc_id AND s.y > r.a + 5 AND s.y <= r.a + 40 GROUP BY r.doc_id, r.a),
placed AS (SELECT t.*, n.a AS line_y,
  CASE WHEN x0 < 90 THEN 'head' WHEN x0 < 180 THEN 'read' WHEN x0 < 300 THEN 'ex' ELSE 'note' END AS col
  FROM tok t ASOF JOIN anchors n ON t.doc_id = n.doc_id AND t.y >= n.a)
SELECT doc_id, line_y, col, count(*) AS n, string_agg(word, ' ' ORDER BY x0, pos) AS text
FROM placed GROUP BY doc_id, line_y, col"""


def _word(i: int):
    return F.coalesce(F.get("w", F.lit(i)), F.lit(""))


def layout_assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences as lines: long first words are heads, long second words readings."""
    rows = B.sentences(spark, sf).withColumn("w", F.regexp_extract_all("text", F.lit(B.WORD), F.lit(0)))
    lined = rows.select(
        "doc_id", "sent",
        F.when(F.length(_word(0)) >= 8, _word(0)).otherwise("").alias("head"),
        F.when(F.length(_word(1)) >= 6, _word(1)).otherwise("").alias("reading"),
        _word(2).alias("ex"), F.array_join(F.slice("w", F.lit(4), F.size("w")), " ").alias("note"))
    return L.assemble_rows(lined, ["doc_id"], "sent")


ASSEMBLE_ORACLE = f"""WITH {B.SENTENCES_SQL},
w AS (SELECT doc_id, sent, regexp_extract_all(text, '{B.WORD}') AS w FROM sentences),
l AS (SELECT doc_id, sent, CASE WHEN length(w[1]) >= 8 THEN w[1] ELSE '' END AS head,
  CASE WHEN length(w[2]) >= 6 THEN w[2] ELSE '' END AS reading, coalesce(w[3], '') AS ex, array_to_string(w[4:], ' ') AS note FROM w),
e AS (SELECT *, sum(CASE WHEN head <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY sent) AS entity FROM l),
r AS (SELECT *, sum(CASE WHEN reading <> '' OR (head <> '' AND (ex <> '' OR note <> '')) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, entity ORDER BY sent) AS "row",
  first_value(head) OVER (PARTITION BY doc_id, entity ORDER BY sent) AS h FROM e WHERE entity > 0)
SELECT doc_id, CAST(entity AS BIGINT) AS entity, CAST("row" AS BIGINT) AS "row", any_value(h) AS head, string_agg(reading, '' ORDER BY sent) AS reading,
  string_agg(ex, '' ORDER BY sent) AS ex, string_agg(note, '' ORDER BY sent) AS note
FROM r WHERE "row" > 0 GROUP BY doc_id, entity, "row" """


def numbered_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences opening with a vowel start an item; the others continue it."""
    t = F.col("text")
    return L.join_numbered(
        B.sentences(spark, sf), ["doc_id"], "sent", "text", t.rlike("^[AEIOUaeiou]"), F.substring(t, 1, 1), X.after(t, F.lit(2))
    ).select("doc_id", "item", "no", F.md5("text").alias("text"))


NUMBERED_ORACLE = f"""WITH {B.SENTENCES_SQL},
o AS (SELECT *, regexp_matches(text, '^[AEIOUaeiou]') AS opens FROM sentences),
g AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY sent) AS item FROM o)
SELECT doc_id, CAST(item AS BIGINT) AS item, max(CASE WHEN opens THEN text[1] END) AS no,
  md5(regexp_replace(string_agg(CASE WHEN opens THEN substr(text, 2) ELSE text END, '' ORDER BY sent), '^[\\s\\x{{A0}}\\x{{3000}}]+|[\\s\\x{{A0}}\\x{{3000}}]+$', '', 'g')) AS text
FROM g WHERE item > 0 GROUP BY doc_id, item"""

RULES = [("head", "Gothic", 9.0, 10.0), ("note", "Gothic", 5.0, 7.0), ("body", "Mincho", 6.0, 9.0), ("ruby", "Mincho", 3.0, 4.5), ("gloss", "Song", 5.0, 6.0)]


def layout_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Roles by font prefix and size band, tallied per language."""
    w = F.col("word")
    font = F.when(w.rlike("^[a-g]"), "GothicBold").when(w.rlike("^[h-r]"), "MinchoPro").otherwise("SongStd")
    tokens = B.words(spark, sf).select("lang", font.alias("font"), (3 + F.length(w) % 8).cast("double").alias("size"))
    return L.classify_roles(tokens, RULES, "font", "size").groupBy("lang", "role").agg(F.count(F.lit(1)).alias("n"))


ROLES_ORACLE = f"""WITH {B.WORDS_SQL},
t AS (SELECT lang, CASE WHEN regexp_matches(word, '^[a-g]') THEN 'G' WHEN regexp_matches(word, '^[h-r]') THEN 'M' ELSE 'S' END AS f, 3 + length(word) % 8 AS s FROM words)
SELECT lang, CASE WHEN f = 'G' AND s BETWEEN 9 AND 10 THEN 'head' WHEN f = 'G' AND s BETWEEN 5 AND 7 THEN 'note'
  WHEN f = 'M' AND s BETWEEN 6 AND 9 THEN 'body' WHEN f = 'M' AND s BETWEEN 3 AND 4.5 THEN 'ruby'
  WHEN f = 'S' AND s BETWEEN 5 AND 6 THEN 'gloss' END AS role, count(*) AS n FROM t GROUP BY ALL"""


def layout_ruby(spark: SparkSession, sf: str) -> DataFrame:
    """Every word typeset one character per cell with rubies above its runs, then annotated again.

    Runs of three letters have a ruby of another weight, runs of two under words of seven one that is too large.
    """
    kana = B.kana_words(spark, sf)
    chars = kana.select("word", F.lit(0).alias("line"), F.posexplode(F.split("surface", "")).alias("i", "c")).where("c <> ''")
    base = chars.select("word", "line", F.lit(100.0).alias("y"), (F.col("i") * 10.0).alias("x"), (F.col("i") * 10.0 + 8).alias("x1"), "c", F.lit("Mincho").alias("font"))
    runs = F.regexp_extract_all("word", F.lit("[aeiou]+|[^aeiou]+"), F.lit(0))
    pieces = kana.select("word", F.posexplode(runs).alias("k", "run"), runs.alias("runs")).select(
        "word", "run", F.length(F.array_join(F.slice("runs", F.lit(1), F.col("k")), "")).alias("at"))
    ruby = pieces.where(~F.col("run").rlike("^[aeiou]")).select(
        "word", F.when(F.length("run") == 3, F.lit("Gothic-M")).otherwise("Mincho-M").alias("font"), F.when((F.length("run") == 2) & (F.length("word") == 7), 5.0).otherwise(4.5).alias("size"), F.lit(93.0).alias("y"), (F.col("at") * 10.0).alias("x0"),
        ((F.col("at") + F.length("run")) * 10.0 - 2).alias("x1"), B.reading_of(F.col("run")).alias("text"))
    return L.attach_ruby(base, ruby, ["word", "line"], 4.5).select("word", "annotated")


RUBY_ORACLE = f"""WITH {B.VOCABULARY_SQL}
SELECT word, array_to_string(list_transform(regexp_extract_all(word, '[aeiou]+|[^aeiou]+'), lambda r:
  CASE WHEN regexp_matches(r, '^[aeiou]') OR length(r) = 3 OR (length(r) = 2 AND length(word) = 7) THEN {B.surface_sql('r')} ELSE {B.surface_sql('r')} || '(' || {B.reading_sql('r')} || ')' END), '') AS annotated
FROM vocabulary"""


def layout_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Per order as a page: the flags found in the box beside each line number."""
    items = table(spark, sf, "lineitem")
    left = items.select("l_orderkey", F.concat_ws("-", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int")).alias("id"), (F.col("l_quantity") * 2).alias("y")).distinct()
    right = items.select(
        "l_orderkey", (150 + F.round(F.col("l_tax") * 100) + F.col("l_linenumber")).alias("x"),
        (F.col("l_quantity") * 2 - F.col("l_linenumber")).alias("y"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    return L.box_lookup(left, right, ["l_orderkey"], (152.0, 162.0), (-6.0, 2.0))


BOXES_ORACLE = """WITH l AS (SELECT DISTINCT l_orderkey, concat_ws('-', l_linenumber, l_partkey, CAST(l_quantity AS INTEGER)) AS id, l_quantity * 2 AS y FROM lineitem),
r AS (SELECT l_orderkey, 150 + round(l_tax * 100) + l_linenumber AS x, l_quantity * 2 - l_linenumber AS y, l_returnflag || l_linestatus AS text FROM lineitem)
SELECT l.l_orderkey, l.id, string_agg(r.text, '' ORDER BY r.x, r.y, r.text) AS text
FROM l JOIN r ON r.l_orderkey = l.l_orderkey AND r.y - l.y BETWEEN -6 AND 2 AND r.x >= 152 AND r.x < 162 GROUP BY l.l_orderkey, l.id"""


def variant_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Variant tokens of every word in round, square, no and broken brackets."""
    s, n = F.col("surface"), F.length("word") % 4
    first, last = F.left("surface", F.lit(1)), F.right("surface", F.lit(1))
    inner = F.concat(first, F.when(F.length("word") % 2 == 0, F.lit("・")).otherwise(F.lit("、 ")), last)
    token = F.when(n == 0, F.concat(F.lit(" （"), inner, F.lit("）"))).when(n == 1, F.concat(F.lit("［"), inner, F.lit("］"))).when(n == 2, inner).otherwise(F.concat(F.lit("（"), s))
    return L.extract_variants(B.kana_words(spark, sf).select("word", token.alias("token")), ["word"], "token")


VARIANT_ORACLE = f"""WITH {B.KANA_SQL}, t AS (SELECT word, length(word) % 4 AS n, unnest([surface[1], right(surface, 1)]) AS variant FROM kana WHERE length(word) % 4 < 3)
SELECT word, variant, CASE n WHEN 1 THEN '許容字体' ELSE '康熙字典体' END AS label FROM t WHERE regexp_full_match(variant, '[\\x{{3005}}\\x{{4E00}}-\\x{{9FFF}}]')"""


def _page_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, line, tok, text, x, x1): words of the paragraphs of every page, set side by side; some stand in the margin."""
    lines = table(spark, sf, "pages").select("page_id", F.posexplode(F.split("html", "<p>", -1)).alias("line", "t"))
    tokens = lines.select("page_id", "line", F.posexplode(F.regexp_extract_all("t", F.lit(B.WORD), F.lit(0))).alias("tok", "word"))
    w, far = F.col("word"), F.when(F.col("tok") > 0, F.col("line") % 3 * 5.0).otherwise(0.0)
    text = F.when(w.rlike("^[aeAE]"), F.lit("→")).when(w.rlike("^[tT]"), F.lit("参")).otherwise(w)
    return tokens.select("page_id", "line", "tok", text.alias("text"), (F.col("tok") * 10.0 + far).alias("x"), (F.col("tok") * 10.0 + far + 8).alias("x1"))


def margin_arrows(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every paragraph without the arrows of its margin."""
    kept = L.drop_margin_arrows(_page_tokens(spark, sf), ["page_id", "line"], "tok", 8.0)
    return kept.groupBy("page_id", "line").agg(
        F.count(F.lit(1)).alias("tokens"), F.count_if(F.col("text") == "→").alias("arrows"),
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("tok", "text"))), lambda t: t["text"]), " ")).alias("text"))


ARROWS_ORACLE = f"""WITH l AS (SELECT page_id, i - 1 AS line, p[i] AS t FROM (SELECT page_id, string_split(html, '<p>') AS p FROM pages) q, unnest(range(1, len(p) + 1)) AS u(i)),
w AS (SELECT page_id, line, i - 1 AS tok, x[i] AS word FROM (SELECT page_id, line, regexp_extract_all(t, '{B.WORD}') AS x FROM l) q, unnest(range(1, len(x) + 1)) AS u(i)),
k AS (SELECT page_id, line, tok, CASE WHEN regexp_matches(word, '^[aeAE]') THEN '→' WHEN regexp_matches(word, '^[tT]') THEN '参' ELSE word END AS text, tok * 10.0 + CASE WHEN tok > 0 THEN line % 3 * 5.0 ELSE 0 END AS x FROM w),
n AS (SELECT *, lead(text) OVER v AS after, lead(x) OVER v AS far FROM k WINDOW v AS (PARTITION BY page_id, line ORDER BY tok))
SELECT page_id, line, count(*) AS tokens, count(*) FILTER (text = '→') AS arrows, md5(string_agg(text, ' ' ORDER BY tok)) AS text
FROM n WHERE NOT (text = '→' AND (coalesce(after = '参', false) OR coalesce(tok = 0 AND far - (x + 8) > 8, false))) GROUP BY page_id, line"""


def circled_items(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences opening with a vowel carry a circled number and start an item; the others continue it."""
    t = F.col("text")
    number = F.substring(F.lit(L.CIRCLED), F.col("sent") % 20 + 1, F.lit(1))
    rows = B.sentences(spark, sf).withColumn("text", F.when(t.rlike("^[AEIOUaeiou]"), F.concat(number, t)).otherwise(t))
    return L.circled_items(rows, ["doc_id"], "sent", "text").select("doc_id", "item", "no", F.md5("text").alias("text"))


CIRCLED_ORACLE = f"""WITH {B.SENTENCES_SQL},
o AS (SELECT *, regexp_matches(text, '^[AEIOUaeiou]') AS opens FROM sentences),
g AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY sent) AS item FROM o)
SELECT doc_id, CAST(item AS BIGINT) AS item, max(CASE WHEN opens THEN substr('{L.CIRCLED}', CAST(sent % 20 AS INTEGER) + 1, 1) END) AS no,
  md5(regexp_replace(string_agg(text, '' ORDER BY sent), '^[\\s\\x{{A0}}\\x{{3000}}]+|[\\s\\x{{A0}}\\x{{3000}}]+$', '', 'g')) AS text
FROM g WHERE item > 0 GROUP BY doc_id, item"""


def layout_carry(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as lines, conversations as entries: tokens without a language follow the next one."""
    found = F.regexp_extract_all("text", F.lit(B.WORD), F.lit(0))
    tokens = table(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(found).alias("tok", "word"))
    language = F.when(F.col("word").rlike("^[a-dA-D]"), "ko").when(F.col("word").rlike("^[lmnLMN]"), "zh")
    resolved = L.carry_language(tokens.withColumn("language", language), ["conv_id"], "turn", "tok", F.col("turn"), "language")
    return resolved.groupBy("conv_id", "turn").agg(
        F.count_if(F.col("resolved") == "ko").alias("ko"), F.count_if(F.col("resolved") == "zh").alias("zh"),
        F.count_if(F.col("resolved").isNull()).alias("none"),
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("resolved") == "ko", F.struct("tok", "word")))), lambda t: t["word"]), " ")).alias("note"))


CARRY_ORACLE = f"""WITH t AS (SELECT conv_id, turn, i AS tok, l[i] AS word,
  CASE WHEN regexp_matches(l[i], '^[a-dA-D]') THEN 'ko' WHEN regexp_matches(l[i], '^[lmnLMN]') THEN 'zh' END AS lang
  FROM (SELECT conv_id, turn, regexp_extract_all(text, '{B.WORD}') AS l FROM conversations) c, unnest(range(1, len(l) + 1)) AS u(i)),
r AS (SELECT *, coalesce(
  first_value(lang IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY tok ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(lang IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, tok ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS res FROM t)
SELECT conv_id, turn, count(*) FILTER (res = 'ko') AS ko, count(*) FILTER (res = 'zh') AS zh, count(*) FILTER (res IS NULL) AS "none",
  md5(coalesce(string_agg(word, ' ' ORDER BY tok) FILTER (res = 'ko'), '')) AS note FROM r GROUP BY conv_id, turn"""


def layout_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Document lines: body lines end anywhere, tail lines continue an unterminated line above."""
    n = F.length("text")
    rows = B.lines(spark, sf).where("text <> ''").select(
        "doc_id", "line", (F.col("line") * 6 + n % 13).cast("double").alias("y0"), "text",
        (n % 3 == 0).alias("body"), (n % 3 == 1).alias("tail"), F.substring(F.rtrim("text"), -1, 1).alias("last"))
    rows = rows.withColumn("y", F.col("line") * 9.0 + F.col("y0") % 9)
    out = L.reattach_tail(rows, ["doc_id"], "y", "body", "tail", "last", [".", "!", "?"])
    return out.select("doc_id", "line", "body", "attached")


TAIL_ORACLE = f"""WITH RECURSIVE {B.LINES_SQL},
a AS (SELECT doc_id, line, line * 9.0 + (line * 6 + length(text) % 13) % 9 AS y, length(text) % 3 = 0 AS body, length(text) % 3 = 1 AS tail,
  right(rtrim(text, ' '), 1) AS ch FROM lines WHERE text <> ''),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y) AS k FROM a WHERE body OR tail),
s AS (
  SELECT doc_id, line, y, body, k, ch, false AS attached, body AS open FROM c WHERE k = 1
  UNION ALL
  SELECT n.doc_id, n.line, n.y, n.body, n.k, n.ch,
    NOT n.body AND s.open AND s.ch NOT IN ('.', '!', '?') AND n.y - s.y > 0 AND n.y - s.y <= 17.5,
    n.body OR (s.open AND s.ch NOT IN ('.', '!', '?') AND n.y - s.y > 0 AND n.y - s.y <= 17.5)
  FROM s JOIN c n ON n.doc_id = s.doc_id AND n.k = s.k + 1)
SELECT doc_id, line, body, attached FROM s"""


def gloss_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Table-like lines split into three languages; quotes tightened."""
    slashed = F.regexp_replace("text", "[|,]", "／")
    g = L.split_gloss(slashed)
    quoted = L.tighten_quotes(F.concat(F.lit("「 "), "text", F.lit("　」")))
    return B.lines(spark, sf).where("text <> ''").select(
        "doc_id", "line", g["en"].alias("en"), g["zh"].alias("zh"), F.md5(g["ko"]).alias("ko"), F.md5(quoted).alias("quoted"))


_WS = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}\x{85}]+"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}|{_WS}$', '', 'g')"


def _marks(c: str) -> str:
    inner = f"regexp_replace({c}, '[参照◆→※ ]+$', '')"
    return _strip(inner)


GLOSS_ORACLE = f"""WITH {B.LINES_SQL},
p AS (SELECT doc_id, line, text, regexp_replace(text, '[|,]', '／', 'g') AS s FROM lines WHERE text <> ''),
q AS (SELECT *, list_transform(string_split(s, '／'), lambda x: {_strip('x')}) AS l FROM p)
SELECT doc_id, line, {_marks("CASE WHEN len(l) >= 3 THEN l[1] ELSE " + _strip('s') + " END")} AS en,
  {_marks("CASE WHEN len(l) >= 3 THEN l[2] ELSE '' END")} AS zh,
  md5({_marks("CASE WHEN len(l) >= 3 THEN array_to_string(l[3:], '／') ELSE '' END")}) AS ko,
  md5('「' || regexp_replace(regexp_replace(text, '^[ 　]+', ''), '[ 　]+$', '') || '」') AS quoted FROM q"""


QUERIES = {
    "variant_tokens": variant_tokens, "margin_arrows": margin_arrows, "circled_items": circled_items,
    "layout_lines": layout_lines, "layout_assemble": layout_assemble, "numbered_items": numbered_items,
    "layout_roles": layout_roles, "layout_ruby": layout_ruby, "layout_boxes": layout_boxes,
    "layout_carry": layout_carry, "layout_tail": layout_tail, "gloss_lines": gloss_lines,
}
ORACLES = {
    "variant_tokens": VARIANT_ORACLE, "margin_arrows": ARROWS_ORACLE, "circled_items": CIRCLED_ORACLE,
    "layout_lines": LINES_ORACLE, "layout_assemble": ASSEMBLE_ORACLE, "numbered_items": NUMBERED_ORACLE,
    "layout_roles": ROLES_ORACLE, "layout_ruby": RUBY_ORACLE, "layout_boxes": BOXES_ORACLE,
    "layout_carry": CARRY_ORACLE, "layout_tail": TAIL_ORACLE, "gloss_lines": GLOSS_ORACLE,
}
