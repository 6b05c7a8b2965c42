"""Inputs shared by the registered queries, each with the SQL that derives the same rows.

The driver tables hold Latin text only, so annotated Japanese is derived from the words of
``documents`` by fixed letter maps: consonants become base characters, vowels become kana.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexframe.functions.text import CASE_FOLDS
from lexframe.session import checkpointed, table

# --- fixed values: word pattern and letter maps ---
WORD = "[A-Za-zÀ-ÿ]+"
SENTENCE = "[^.\n]+"
LETTERS = "aeioubcdfghjklmnpqrstvwxyz" "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß×÷"
SURFACES = "あえいおう部科田符語歩児木里見名品急路差手場和字夜図" "雨円王音花貝学気休玉金空犬左山子糸車出女森水正生青石赤先草足村男竹虫"
READINGS = "あえいおうぶかだふごほじきりみなぴくらさたばわずやつ" "ぶかだふごほじきりみなぴくらさたばわずやつぶかだふごほじきりみなぴく"
LENGTHENED = (("な", "なん"), ("さ", "さう"), ("か", "ちょ"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


def words(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lang, pos, word): every word of every document, lower-cased, 1-based position."""
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    return documents(spark, sf).select(
        "doc_id", "lang", F.posexplode(found).alias("pos", "word")
    ).select("doc_id", "lang", (F.col("pos") + 1).alias("pos"), F.lower("word").alias("word"))


WORDS_SQL = f"""words AS MATERIALIZED (
  SELECT doc_id, lang, pos, lower(w) AS word FROM (
    SELECT doc_id, lang, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS w
    FROM (SELECT doc_id, lang, regexp_extract_all(text, '{WORD}') AS l FROM documents) d))"""


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lang, sent, text): trimmed non-empty pieces between dots and line ends."""
    found = F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))
    return (
        documents(spark, sf)
        .select("doc_id", "lang", F.posexplode(found).alias("sent", "text"))
        .select("doc_id", "lang", (F.col("sent") + 1).alias("sent"), F.trim("text").alias("text"))
        .where("text <> ''")
    )


SENTENCES_SQL = f"""sentences AS (
  SELECT * FROM (
    SELECT doc_id, lang, i AS sent, trim(l[i], ' ') AS text
    FROM (SELECT doc_id, lang, regexp_extract_all(text, '[^.\\n]+') AS l FROM documents) d,
         unnest(range(1, len(l) + 1)) AS t(i)) WHERE text <> '')"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lang, line, text): physical lines of the documents."""
    return documents(spark, sf).select(
        "doc_id", "lang", F.posexplode(F.split("text", "\n", -1)).alias("line", "text")
    ).withColumn("line", F.col("line") + 1)


LINES_SQL = """lines AS (
  SELECT doc_id, lang, i AS line, l[i] AS text
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents) d,
       unnest(range(1, len(l) + 1)) AS t(i))"""


SMALL, LARGE = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def capitalised(c: Column) -> Column:
    return F.concat(F.translate(F.left(c, F.lit(1)), SMALL, LARGE), F.substring(c, F.lit(2), F.length(c)))


def capitalised_sql(c: str) -> str:
    return f"translate({c}[1], '{SMALL}', '{LARGE}') || {c}[2:]"


def fold_sql(c: str) -> str:
    out = f"lower({c})"
    for letter, folded in CASE_FOLDS.items():
        out = f"replace({out}, '{letter}', '{folded}')"
    return out


def surface_of(c: Column) -> Column:
    return F.translate(c, LETTERS, SURFACES)


def reading_of(c: Column) -> Column:
    out = F.translate(c, LETTERS, READINGS)
    for short, long in LENGTHENED:
        out = F.replace(out, F.lit(short), F.lit(long))
    return out


def annotated_of(c: Column) -> Column:
    runs = F.regexp_extract_all(c, F.lit("[aeiou]+|[^aeiou]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(
        r.rlike("^[aeiou]"), reading_of(r)).otherwise(F.concat(surface_of(r), F.lit("("), reading_of(r), F.lit(")")))), "")


def surface_sql(c: str) -> str:
    return f"translate({c}, '{LETTERS}', '{SURFACES}')"


def reading_sql(c: str) -> str:
    out = f"translate({c}, '{LETTERS}', '{READINGS}')"
    for short, long in LENGTHENED:
        out = f"replace({out}, '{short}', '{long}')"
    return out


def annotated_sql(c: str) -> str:
    r = reading_sql("r")
    return (
        f"array_to_string(list_transform(regexp_extract_all({c}, '[aeiou]+|[^aeiou]+'), lambda r: "
        f"CASE WHEN regexp_matches(r, '^[aeiou]') THEN {r} ELSE {surface_sql('r')} || '(' || {r} || ')' END), '')"
    )


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """(word, freq): distinct words of all documents with their counts.

    Materialised: a filter on what is derived from a word would else be pushed below the grouping and
    worked out for every place of the word, and every use of the table would count the words anew.
    """
    return checkpointed(words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


VOCABULARY_SQL = WORDS_SQL + """, vocabulary AS MATERIALIZED (
  SELECT word, count(*) AS freq FROM words GROUP BY word)"""


def kana_words(spark: SparkSession, sf: str) -> DataFrame:
    """(word, freq, surface, reading, annotated) for every distinct word."""
    w = F.col("word")
    return vocabulary(spark, sf).select(
        "word", "freq", surface_of(w).alias("surface"), reading_of(w).alias("reading"), annotated_of(w).alias("annotated"))


KANA_SQL = VOCABULARY_SQL + f""", kana AS MATERIALIZED (
  SELECT word, freq, {surface_sql('word')} AS surface, {reading_sql('word')} AS reading, {annotated_sql('word')} AS annotated
  FROM vocabulary)"""


def benchmark_words(spark: SparkSession, sf: str) -> DataFrame:
    """(word): distinct lower-cased words of the benchmark passages, the lexicon of several queries."""
    return table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word")
    ).select(F.lower("word").alias("word")).distinct()


BENCHMARK_SQL = f"""benchmark_words AS (
  SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS w FROM benchmark))"""


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """(surface, reading, reading_ord, pos): benchmark words; every third length has a second, voiced reading."""
    rows = benchmark_words(spark, sf)
    first = reading_of(F.col("word"))
    second = F.when(F.length("word") % 3 == 0, F.translate(first, "たほ", "だぼ"))
    listed = rows.select(
        surface_of(F.col("word")).alias("surface"), F.posexplode(F.array_distinct(F.array_compact(F.array(first, second)))).alias("reading_ord", "reading"),
        F.when(F.length("word") % 2 == 0, F.array(F.lit("&v5r;"), F.lit("&vi;"))).otherwise(F.array(F.lit("&n;"))).alias("pos"))
    return listed.select("surface", "reading", "reading_ord", "pos")


DICTIONARY_SQL = BENCHMARK_SQL + f""", dict0 AS (
  SELECT word, {surface_sql('word')} AS surface, {reading_sql('word')} AS reading, length(word) % 2 = 0 AS verb
  FROM benchmark_words),
dict AS (SELECT surface, reading, 0 AS reading_ord, verb FROM dict0
  UNION ALL SELECT surface, translate(reading, 'たほ', 'だぼ'), 1, verb FROM dict0
  WHERE length(word) % 3 = 0 AND translate(reading, 'たほ', 'だぼ') <> reading)"""

CAND_SQL = """runs AS (SELECT word, surface, reading, regexp_extract_all(surface, '[\\x{4E00}-\\x{9FFF}]+|[^\\x{4E00}-\\x{9FFF}]+') AS r FROM pairs),
walk AS (
  SELECT word, 0 AS i, 0 AS pos, '' AS text FROM runs
  UNION ALL
  SELECT w.word, w.i + 1, w.pos + n, w.text || r.r[w.i + 1] ||
    CASE WHEN regexp_matches(r.r[w.i + 1], '[\\x{4E00}-\\x{9FFF}]') THEN '(' || substr(r.reading, w.pos + 1, n) || ')' ELSE '' END
  FROM walk w JOIN runs r ON r.word = w.word,
    unnest(range(length(r.r[w.i + 1]), greatest(length(r.reading) - w.pos, 0) + 1)) AS t(n)
  WHERE w.i < len(r.r) AND CASE WHEN regexp_matches(r.r[w.i + 1], '[\\x{4E00}-\\x{9FFF}]')
    THEN substr(r.reading, w.pos + 1, 1) NOT IN ('ゃ', 'ゅ', 'ょ', 'っ', 'ー') AND n <= length(r.reading) - w.pos - length(array_to_string(r.r[w.i + 2:], ''))
    ELSE n = length(r.r[w.i + 1]) AND substr(r.reading, w.pos + 1, n) = r.r[w.i + 1] END),
cands AS (SELECT w.word, w.text AS candidate FROM walk w JOIN runs r ON r.word = w.word WHERE w.i = len(r.r) AND w.pos = length(r.reading))"""

RUNS_SQL = """cruns AS (SELECT c.word, c.candidate, i, l[i] AS tok, coalesce(l[i + 1], '') AS nxt FROM (
    SELECT word, candidate, regexp_extract_all(candidate, '[\\x{4E00}-\\x{9FFF}]+\\([^)]*\\)|[^\\x{4E00}-\\x{9FFF}(]+') AS l FROM cands) c,
    unnest(range(1, len(l) + 1)) AS u(i)),
seg AS (SELECT word, candidate, regexp_extract(tok, '^([^(]+)\\(', 1) AS surface, regexp_extract(tok, '\\(([^)]*)\\)', 1) AS reading,
  CASE WHEN contains(nxt, '(') THEN '' ELSE nxt END AS tail FROM cruns WHERE contains(tok, '(')),
forms AS (SELECT 'd' AS kind, surface AS head, reading AS f FROM dict
  UNION SELECT 's', regexp_extract(surface, '^(.*[\\x{4E00}-\\x{9FFF}])[^\\x{4E00}-\\x{9FFF}]+$', 1),
    reading[:-(length(surface) - length(regexp_extract(surface, '^(.*[\\x{4E00}-\\x{9FFF}])[^\\x{4E00}-\\x{9FFF}]+$', 1)) + 1)] FROM dict
  WHERE regexp_matches(surface, '[\\x{4E00}-\\x{9FFF}][^\\x{4E00}-\\x{9FFF}]+$')
    AND ends_with(reading, regexp_extract(surface, '([^\\x{4E00}-\\x{9FFF}]+)$', 1)) AND length(reading) > length(regexp_extract(surface, '([^\\x{4E00}-\\x{9FFF}]+)$', 1))),
voiced AS (SELECT kind, head, f FROM forms
  UNION SELECT kind, head, translate(f[1], 'かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ') || f[2:] FROM forms
  UNION SELECT kind, head, translate(f[1], 'はひふへほ', 'ぱぴぷぺぽ') || f[2:] FROM forms),
dseg AS (SELECT DISTINCT surface, reading, tail FROM seg),
asked AS (SELECT surface, reading, tail, 'd' AS kind, surface || tail[:k] AS head, reading || tail[:k] AS given FROM dseg, unnest(range(0, length(tail) + 1)) AS t(k)
  UNION ALL SELECT surface, reading, tail, 's', surface, reading FROM dseg),
fit AS (SELECT a.surface, a.reading, a.tail, count(v.f) = 0 OR coalesce(bool_or(v.f = a.given), false) AS fits
  FROM asked a LEFT JOIN voiced v ON v.kind = a.kind AND v.head = a.head GROUP BY ALL),
cfit AS (SELECT word, candidate, coalesce(bool_and(fits) FILTER (length(surface) >= 2), true) AS fits_long, bool_and(fits) AS fits_all
  FROM seg JOIN fit USING (surface, reading, tail) GROUP BY word, candidate),
jc AS (SELECT c.word, c.candidate, coalesce(fits_long, true) AS fl, coalesce(fits_all, true) AND coalesce(fits_long, true) AS fa
  FROM cands c LEFT JOIN cfit f USING (word, candidate)),
per AS (SELECT word, count(*) AS n, count(*) FILTER (fl) AS nl, count(*) FILTER (fa) AS na, max(candidate) AS only_c, bool_or(fl) AS only_f,
  max(candidate) FILTER (fl) AS one_l, max(candidate) FILTER (fa) AS one_a FROM jc GROUP BY word),
chosen AS (SELECT * FROM (SELECT word, CASE WHEN n = 1 THEN only_c WHEN nl = 1 THEN one_l WHEN nl > 1 AND na = 1 THEN one_a END AS written,
  CASE WHEN n = 1 THEN only_f ELSE true END AS fits_long FROM per) WHERE written IS NOT NULL)"""
