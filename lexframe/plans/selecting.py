"""Residual readings, frequency selection, re-keying, inflection keys and note columns over words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import notes as N, select as S
from lexframe.plans import base as B
from lexframe.plans.aligning import SINGLE_SQL, _single_readings

# --- fixed values: target characters of the selection, with official keys for two of them ---
TARGETS = "部科語木見名"
OFFICIAL = (("部", "ブ"), ("木", "ギ"))


def _targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in TARGETS], "ch string")


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    return _single_readings(spark, sf).select("ch", F.col("key").alias("reading"))


_GEM = """gem AS (SELECT ch, key AS f FROM single UNION SELECT ch, key[:-2] || 'っ' FROM single WHERE key[-1] IN ('つ', 'く', 'き', 'ち'))"""
_PATHS = f"""w AS (SELECT word, surface, reading, regexp_extract_all(surface, '[\\x{{4E00}}-\\x{{9FFF}}]|[ぁ-ん]+') AS t FROM kana
  WHERE regexp_matches(surface, '[{TARGETS}]')),
walk AS (
  SELECT word, 0 AS i, 0 AS p, 0 AS o, '' AS res FROM w
  UNION
  SELECT k.word, k.i + 1, k.p + n, k.o + CASE WHEN regexp_matches(w.t[k.i + 1], '[ぁ-ん{TARGETS}]') THEN 0 ELSE n END,
    k.res || CASE WHEN contains('{TARGETS}', w.t[k.i + 1]) THEN substr(w.reading, k.p + 1, CAST(n AS INTEGER)) ELSE '' END
  FROM walk k JOIN w ON w.word = k.word, unnest(range(1, length(w.reading) - k.p + 1)) AS u(n)
  WHERE k.i < len(w.t) AND CASE WHEN regexp_matches(w.t[k.i + 1], '[ぁ-ん]') THEN n = length(w.t[k.i + 1]) AND substr(w.reading, k.p + 1, CAST(n AS INTEGER)) = w.t[k.i + 1]
    WHEN contains('{TARGETS}', w.t[k.i + 1]) THEN true
    ELSE EXISTS (SELECT 1 FROM gem WHERE gem.ch = w.t[k.i + 1] AND gem.f = substr(w.reading, k.p + 1, CAST(n AS INTEGER))) END),
resid AS (SELECT k.word, arg_min(k.res, (-k.o, length(k.res), k.res)) AS residual FROM walk k JOIN w ON w.word = k.word
  WHERE k.i = len(w.t) AND k.p = length(w.reading) GROUP BY k.word)"""


def residual_reading(spark: SparkSession, sf: str) -> DataFrame:
    """What the target characters sound like in every word that holds one."""
    words = B.kana_words(spark, sf).where(F.col("surface").rlike(f"[{TARGETS}]"))
    return S.best_residual(words, ["word"], "surface", "reading", S.geminated_forms(_readings(spark, sf)), _targets(spark))


RESIDUAL_ORACLE = f"WITH RECURSIVE {B.KANA_SQL}, {SINGLE_SQL}, {_GEM}, {_PATHS} SELECT word, residual FROM resid"


def select_examples(spark: SparkSession, sf: str) -> DataFrame:
    freq = B.kana_words(spark, sf).select(F.col("surface").alias("lemma"), F.col("reading").alias("form"), "freq")
    empty = B.dictionary(spark, sf).where("reading_ord = 0")
    official = spark.createDataFrame(list(OFFICIAL), "ch string, key string")
    out = S.select_examples(freq, empty, _readings(spark, sf), _targets(spark), official, cap=None)
    return out.select("ch", "reading", "place", "rank", "lemma", "freq")


SELECT_ORACLE = f"""WITH RECURSIVE {B.KANA_SQL}, {SINGLE_SQL}, {_GEM}, {_PATHS},
c AS (SELECT DISTINCT unnest(string_split(surface, '')) AS ch, surface AS lemma, freq, residual FROM resid JOIN kana USING (word)),
off(ch, key, hira) AS (VALUES ('部', 'ブ', 'ぶ'), ('木', 'ギ', 'ぎ')),
b AS (SELECT c.ch, o.key AS reading, lemma, freq FROM c JOIN off o ON o.ch = c.ch AND o.hira = c.residual
  UNION ALL SELECT ch, residual, lemma, freq FROM c WHERE contains('{TARGETS}', ch) AND ch NOT IN (SELECT ch FROM off)),
s AS (SELECT ch, reading, max(freq) AS best FROM b GROUP BY ALL UNION ALL
  SELECT ch, key, 0 FROM off WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.ch = off.ch)),
p AS (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY best DESC, reading) AS place FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY ch, reading ORDER BY freq DESC, lemma DESC) AS rank FROM b QUALIFY rank <= 3)
SELECT p.ch, p.reading, p.place, r.rank, r.lemma, r.freq FROM p LEFT JOIN r ON r.ch = p.ch AND r.reading = p.reading"""


def rekey_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Every word filed under its last character's reading, moved where the dictionary reads it otherwise."""
    kana = B.kana_words(spark, sf).where(F.col("word").rlike("[^aeiou]"))
    last = F.regexp_extract("word", "([^aeiou])[aeiou]*$", 1)
    shift = F.when(F.length("word") % 2 == 0, F.translate(last, "bcdfgh", "hgfdcb")).otherwise(last)
    rows = kana.select(B.surface_of(last).alias("ch"), F.translate(shift, B.LETTERS, B.READINGS).alias("reading"), F.col("freq").alias("ord"), F.col("surface").alias("w"))
    singles = _readings(spark, sf)
    on = singles.where("reading > 'な'").select("ch", X.romanize(F.col("reading")).alias("value"))
    full = kana.select("surface", "reading", F.lit(0).alias("reading_ord")).where(F.length("surface") % 3 != 0)
    return S.rekey_examples(rows, full, singles, on)


_SF = """sf AS (SELECT ch, f FROM gem UNION SELECT ch, translate(key[1], 'かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ') || key[2:] FROM single
  UNION SELECT ch, translate(key[1], 'はひふへほ', 'ぱぴぷぺぽ') || key[2:] FROM single
  UNION SELECT ch, translate(key[1], 'がぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽ', 'かきくけこさしすせそたちつてとはひふへほはひふへほ') || key[2:] FROM single)"""
REKEY_ORACLE = f"""WITH RECURSIVE {B.KANA_SQL}, {SINGLE_SQL}, {_GEM}, {_SF},
k AS (SELECT word, surface, reading, freq, regexp_extract(word, '([^aeiou])[aeiou]*$', 1) AS l FROM kana WHERE regexp_matches(word, '[^aeiou]')),
d AS (SELECT *, {B.surface_sql('l')} AS ch, translate(CASE WHEN length(word) % 2 = 0 THEN translate(l, 'bcdfgh', 'hgfdcb') ELSE l END, '{B.LETTERS}', '{B.READINGS}') AS rd FROM k),
w AS (SELECT *, regexp_extract_all(surface, '[\\x{{4E00}}-\\x{{9FFF}}]|[ぁ-ん]+') AS t FROM d WHERE length(word) % 3 <> 0 AND length(replace(surface, ch, '')) = length(surface) - 1),
walk AS (SELECT word, 0 AS i, 0 AS p, '' AS res FROM w
  UNION SELECT k.word, k.i + 1, k.p + CAST(n AS INTEGER), CASE WHEN w.t[k.i + 1] = w.ch THEN substr(w.reading, k.p + 1, CAST(n AS INTEGER)) ELSE k.res END
  FROM walk k JOIN w ON w.word = k.word, unnest(range(1, length(w.reading) - k.p + 1)) AS u(n)
  WHERE k.i < len(w.t) AND CASE WHEN regexp_matches(w.t[k.i + 1], '[ぁ-ん]') THEN n = length(w.t[k.i + 1]) AND substr(w.reading, k.p + 1, CAST(n AS INTEGER)) = w.t[k.i + 1]
    WHEN w.t[k.i + 1] = w.ch THEN true ELSE EXISTS (SELECT 1 FROM sf WHERE sf.ch = w.t[k.i + 1] AND sf.f = substr(w.reading, k.p + 1, CAST(n AS INTEGER))) END),
res AS (SELECT k.word, min(k.res) AS r FROM walk k JOIN w ON w.word = k.word WHERE k.i = len(w.t) AND k.p = length(w.reading) GROUP BY k.word HAVING count(DISTINCT k.res) = 1),
f AS (SELECT DISTINCT rd, x FROM (SELECT rd, unnest([rd, translate(rd[1], 'かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ') || rd[2:],
  translate(rd[1], 'はひふへほ', 'ぱぴぷぺぽ') || rd[2:], translate(rd[1], 'がぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽ', 'かきくけこさしすせそたちつてとはひふへほはひふへほ') || rd[2:],
  CASE WHEN rd[-1] IN ('つ', 'く', 'き', 'ち') THEN rd[:-2] || 'っ' ELSE rd END]) AS x FROM d)),
heard AS (SELECT DISTINCT word FROM d JOIN f USING (rd) LEFT JOIN res USING (word) WHERE length(word) % 3 <> 0 AND (contains(reading, x) OR x = res.r)),
roman(k, v) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in X.ROMAN.items())}),
onr AS (SELECT DISTINCT s.ch, s.key FROM single s WHERE s.key > 'な'),
o AS (SELECT d.ch, d.rd AS from_reading, d.freq AS ord, d.surface AS w, length(d.word) % 3 <> 0 AND h.word IS NULL AS moved,
  CASE WHEN length(d.word) % 3 = 0 OR h.word IS NOT NULL THEN d.rd WHEN res.r IS NULL THEN d.reading
    WHEN EXISTS (SELECT 1 FROM onr WHERE onr.ch = d.ch AND onr.key = res.r) OR EXISTS (SELECT 1 FROM onr, roman a, roman b WHERE onr.ch = d.ch AND a.k = onr.key AND b.k = res.r AND a.v = b.v)
      THEN translate(res.r, '{X.HIRAGANA}', '{X.KATAKANA}') ELSE res.r END AS key,
  CASE WHEN length(d.word) % 3 <> 0 AND h.word IS NULL AND res.r IS NULL THEN 'except' ELSE 'readings' END AS bucket
  FROM d LEFT JOIN heard h USING (word) LEFT JOIN res USING (word))
SELECT ch, CASE WHEN count(*) FILTER (bucket = 'readings') OVER (PARTITION BY ch) = 0 THEN 'readings' ELSE bucket END AS bucket, key, from_reading, ord, w, moved FROM o"""


def inflection_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys inferred from the okurigana of example words; readings are their last three kana."""
    kana = B.kana_words(spark, sf).where(F.col("word").rlike("[^aeiou]"))
    last = B.surface_of(F.regexp_extract("word", "([^aeiou])[aeiou]*$", 1))
    tail = F.substring("reading", -3, 3)
    reading = F.when(F.length("word") % 3 == 0, F.regexp_replace(tail, "い$", "う")).otherwise(tail)
    return S.infer_reading_key(kana.select(last.alias("ch"), reading.alias("reading"), F.col("freq").alias("ord"), F.col("surface").alias("example")))


INFLECT_ORACLE = f"""WITH {B.KANA_SQL},
r AS (SELECT {B.surface_sql("regexp_extract(word, '([^aeiou])[aeiou]*$', 1)")} AS ch, {B.surface_sql("word")} AS s, right(reading, 3) AS t, length(word) % 3 = 0 AS u FROM kana WHERE regexp_matches(word, '[^aeiou]')),
e AS (SELECT ch, CASE WHEN u THEN regexp_replace(t, 'い$', 'う') ELSE t END AS reading, s FROM r),
o AS (SELECT ch, reading, unnest(list_transform(string_split(s, ch)[2:], lambda x: regexp_extract(x, '^[ぁ-ん]*'))) AS suf FROM e),
p AS (SELECT ch, reading, max(CASE WHEN ends_with(reading, suf) AND length(reading) > length(suf) THEN length(suf) END) AS n,
  coalesce(bool_or(NOT ends_with(reading, suf) AND length(suf) = 1 AND length(reading) > 1 AND (right(reading, 1), suf) IN (('う', 'い'), ('く', 'き'), ('ぐ', 'ぎ'), ('す', 'し'), ('つ', 'ち'), ('ぬ', 'に'), ('ぶ', 'び'), ('む', 'み'), ('る', 'り'))), false) AS ren
  FROM o WHERE suf <> '' GROUP BY ALL),
d AS (SELECT DISTINCT ch, reading, right(reading, 1) IN ('う', 'く', 'ぐ', 'す', 'つ', 'ぬ', 'ぶ', 'む', 'る', 'い') AND reading NOT IN ({", ".join(f"'{x}'" for x in S.NUMERALS + S.NOUNS)}) AS infl FROM e)
SELECT d.ch, d.reading, CASE WHEN infl AND n IS NOT NULL THEN left(d.reading, length(d.reading) - n) || 'ー' WHEN infl AND ren THEN left(d.reading, length(d.reading) - 1) || 'ー' ELSE d.reading END AS key,
  CASE WHEN NOT infl THEN 'plain' WHEN n IS NOT NULL THEN 'surface' WHEN ren THEN 'renyo' ELSE 'uninflected' END AS method
FROM d LEFT JOIN p ON p.ch = d.ch AND p.reading = d.reading"""


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    """(word, reading, note): every kind of note text, chosen by the length of the word."""
    n = F.length("word") % 10
    s, r, two = F.col("surface"), F.col("reading"), F.concat(F.col("surface"), F.lit("」，「木"), F.col("surface"))
    q = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    note = (
        F.when(n == 0, q("「", r, "」とも。")).when(n == 1, q("「", s, "」は，「", r, "」，「わ」とも。"))
        .when(n == 2, q("「", two, "」などは，「", r, "」，「え", r, "」。⇔", s, "，元，")).when(n == 3, q("「", s, "」は，「木」とも書く。"))
        .when(n == 4, q("「", s, "」とも書く。")).when(n == 5, q("「", s, "（わ）」は，「", r, "」と読むこともある。"))
        .when(n == 6, q("木", s, "（", r, "）県，［", s, "］＝許容字体")).when(n == 7, q("「山頂」の意。"))
        .when(n == 8, q("「", two, "」は，「", r, "」。")).otherwise(q("木木，木山県⇔", s)))
    return B.kana_words(spark, sf).select("word", "surface", "reading", note.alias("note"))


def notes_classify(spark: SparkSession, sf: str) -> DataFrame:
    rows = _notes(spark, sf).withColumn("ch", F.substring("surface", 1, 1))
    out = N.classify_notes(rows.withColumnRenamed("word", "id"), ["id"], "ch", "reading", "note")
    return out.select(F.col("id").alias("word"), "ord", "kind", "of", F.coalesce("word", F.lit("")).alias("w0"), F.coalesce("reading", F.lit("")).alias("reading"),
                      F.coalesce("written", F.lit("")).alias("written"), F.coalesce(F.array_join("words", "|"), F.lit("")).alias("words"),
                      F.coalesce("body", F.lit("")).alias("body"))


NOTES_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) % 10 AS n FROM kana),
e AS (
  SELECT word, reading AS "of", 0 AS ord, 'also_reading' AS kind, '' AS w, reading, '' AS written, '' AS words, '' AS body FROM k WHERE n = 0
  UNION ALL SELECT word, reading, o, 'also_read', surface, CASE o WHEN 0 THEN reading ELSE 'わ' END, '', '', '' FROM k, (VALUES (0), (1)) t(o) WHERE n = 1
  UNION ALL SELECT word, reading, 0, 'same_kun', '', '', '', surface || '|元', '' FROM k WHERE n = 2
  UNION ALL SELECT word, reading, o, 'special_reading', CASE o WHEN 1 THEN surface ELSE '木' || surface END, CASE o WHEN 1 THEN reading ELSE 'え' || reading END, '', '', '' FROM k, (VALUES (1), (2)) t(o) WHERE n = 2
  UNION ALL SELECT word, reading, 0, 'also_written', surface, '', '木', '', '' FROM k WHERE n = 3
  UNION ALL SELECT word, reading, 0, 'also_written', surface[1], '', surface, '', '' FROM k WHERE n = 4
  UNION ALL SELECT word, reading, 0, 'also_read', surface || '（わ）', reading, '', '', '' FROM k WHERE n = 5
  UNION ALL SELECT word, reading, 0, 'text', '', '', '', '', '「山頂」の意。' FROM k WHERE n = 7
  UNION ALL SELECT word, reading, 0, 'reject', '', '', '', '', '「' || surface || '」，「木' || surface || '」は，「' || reading || '」。' FROM k WHERE n = 8
  UNION ALL SELECT word, reading, 0, 'same_kun', '', '', '', surface, '' FROM k WHERE n = 9)
SELECT word, ord, kind, "of", w AS w0, reading, written, words, body FROM e"""


def notes_mined(spark: SparkSession, sf: str) -> DataFrame:
    """Examples mined from the same notes, and the name-reading pairs printed in them."""
    rows = _notes(spark, sf)
    # outer, so that no filter on the array of examples is inferred, which would find them once more
    mined = rows.select("word", F.posexplode_outer(N.mined_examples(F.col("note"))).alias("ord", "example")).where("ord is not null")
    pairs = N.prefecture_pairs(rows, "note").select(F.lit("").alias("word"), F.lit(-1).alias("ord"), F.concat_ws("=", "surface", "reading").alias("example"))
    return mined.unionByName(pairs)


MINED_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) % 10 AS n FROM kana),
m AS (SELECT word, 0 AS ord, '［' || surface || '］＝許容字体' AS example FROM k WHERE n = 6)
SELECT * FROM m UNION ALL SELECT word, ord, example FROM (
  SELECT word, o AS ord, CASE o WHEN 0 THEN '木木' ELSE '木山県' END AS example FROM k, (VALUES (0), (1)) t(o) WHERE n = 9)
UNION ALL SELECT DISTINCT '', -1, coalesce(nullif(regexp_extract('木' || surface, '[\\x{{4E00}}-\\x{{9FFF}}]+$'), ''), 'x') || '=' || reading FROM k WHERE n = 6 AND regexp_matches('木' || surface, '[\\x{{4E00}}-\\x{{9FFF}}]$')"""


def reference_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Words in document order as printed lines: vowel-only words are readings, others belong to the last one."""
    w = F.col("word")
    shown = F.when(w.rlike("^[aeiou]+$"), B.reading_of(w)).when(F.length(w) % 4 == 0, F.concat(B.surface_of(w), F.lit("（わ）"))).when(
        F.length(w) % 9 == 0, F.concat(F.lit("※"), w)).otherwise(B.surface_of(w))
    rows = B.words(spark, sf).select("doc_id", "pos", shown.alias("text"))
    return N.parse_references(rows, ["doc_id"], "pos", "text").select("doc_id", "entry", "reading", "ord", "surface")


REFLIST_ORACLE = f"""WITH {B.WORDS_SQL}, r AS (SELECT doc_id, pos, word, regexp_full_match(word, '[aeiou]+') AS kana FROM words
  WHERE (regexp_full_match(word, '[aeiou]+') OR length(word) % 4 = 0 OR length(word) % 9 <> 0)),
e AS (SELECT *, sum(CASE WHEN kana THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS entry,
  last_value(CASE WHEN kana THEN {B.reading_sql('word')} END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS reading FROM r)
SELECT doc_id, CAST(entry AS BIGINT) AS entry, reading, row_number() OVER (PARTITION BY doc_id, entry ORDER BY pos) - 1 AS ord, {B.surface_sql('word')} AS surface
FROM e WHERE NOT kana AND entry > 0"""

QUERIES = {
    "residual_reading": residual_reading, "select_examples": select_examples, "rekey_examples": rekey_examples,
    "inflection_keys": inflection_keys, "notes_classify": notes_classify, "notes_mined": notes_mined, "reference_lists": reference_lists,
}
ORACLES = {
    "residual_reading": RESIDUAL_ORACLE, "select_examples": SELECT_ORACLE, "rekey_examples": REKEY_ORACLE,
    "inflection_keys": INFLECT_ORACLE, "notes_classify": NOTES_ORACLE, "notes_mined": MINED_ORACLE, "reference_lists": REFLIST_ORACLE,
}
