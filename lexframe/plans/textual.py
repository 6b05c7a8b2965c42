"""Queries over the text functions, on words and lines of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.plans import base as B


def text_fold_kinds(spark: SparkSession, sf: str) -> DataFrame:
    third = F.length("word") % 3
    key = F.when(third == 0, F.col("reading")).when(third == 1, X.kana_unfold(F.col("reading"))).otherwise(F.concat("reading", F.lit("ー")))
    rows = B.kana_words(spark, sf).withColumn("key", key)
    return rows.select(
        "word", "key", X.kana_fold(F.col("key")).alias("folded"), X.reading_norm(F.col("key")).alias("norm"),
        X.reading_kind(F.col("key")).alias("kind"), X.is_base(F.col("surface")).alias("all_base"),
        X.is_kana(F.col("surface")).alias("all_kana"),
        X.reading_matches(F.col("reading"), F.col("key")).alias("matches"))


KATA = "".join(chr(c) for c in range(0x30A1, 0x30F7))
HIRA = "".join(chr(c) for c in range(0x3041, 0x3097))
FOLD_KINDS_SQL = f"""WITH {B.KANA_SQL},
k AS (SELECT *, CASE length(word) % 3 WHEN 0 THEN reading WHEN 1 THEN translate(reading, '{HIRA}', '{KATA}') ELSE reading || 'ー' END AS key FROM kana),
f AS (SELECT *, translate(key, '{KATA}', '{HIRA}') AS folded FROM k)
SELECT word, key, folded, replace(replace(folded, 'ー', ''), 'っ', 'つ') AS norm,
  CASE WHEN regexp_full_match(key, '[ぁ-ゟ]+ー') THEN 'verb' WHEN regexp_full_match(key, '[ァ-ヺ]+') THEN 'on'
       WHEN regexp_full_match(key, '[ぁ-ゟ]+') THEN 'kun' END AS kind,
  NOT regexp_matches(word, '[aeiou]') AS all_base, regexp_full_match(word, '[aeiou]+') AS all_kana,
  contains(replace(replace(reading, 'ー', ''), 'っ', 'つ'), replace(replace(folded, 'ー', ''), 'っ', 'つ')) AS matches
FROM f"""


def sound_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Variant sets of every reading, as rows, with the romanised spelling of each variant."""
    rows = B.kana_words(spark, sf).select("word", F.explode(X.phonetic_variants(F.col("reading"))).alias("variant"))
    return rows.select("word", "variant", X.romanize(F.col("variant")).alias("roman"))


def _roman_values() -> str:
    pairs = list(X.ROMAN.items())
    return ", ".join(f"('{k}', '{v}')" for k, v in pairs)


SOUND_SQL = f"""WITH {B.KANA_SQL},
h AS (SELECT word, reading, reading[1] AS c, reading[2:] AS t FROM kana),
heads AS (SELECT word, c AS head, t, reading FROM h
  UNION SELECT word, translate(c, '{X.PLAIN_HEADS}', '{X.VOICED_HEADS}'), t, reading FROM h
  UNION SELECT word, translate(c, '{X.H_HEADS}', '{X.P_HEADS}'), t, reading FROM h),
v AS (SELECT word, head || t AS variant FROM heads
  UNION SELECT word, head || t[:-2] || 'っ' FROM heads WHERE length(reading) > 1 AND contains('つくきち', reading[-1])),
roman(k, r) AS (VALUES {_roman_values()}),
tok AS (SELECT word, variant, i, l[i] AS t, substr(coalesce(l[i + 1], ''), 1, 1) AS nxt
  FROM (SELECT word, variant, regexp_extract_all(variant, 'っ|.[ゃゅょ]|.') AS l FROM v) x, unnest(range(1, len(l) + 1)) AS u(i)),
spelt AS (SELECT word, variant, i,
  CASE WHEN t = 'っ' THEN substr(coalesce(n.r, ''), 1, 1)
       WHEN length(t) = 2 THEN substr(coalesce(b.r, ''), 1, greatest(length(coalesce(b.r, '')) - 1, 0))
         || CASE WHEN coalesce(b.r, '') IN ('SHI', 'CHI', 'JI') THEN '' ELSE 'Y' END
         || CASE t[2] WHEN 'ゃ' THEN 'A' WHEN 'ゅ' THEN 'U' ELSE 'O' END
       ELSE coalesce(b.r, '') END AS s
  FROM tok LEFT JOIN roman b ON b.k = substr(t, 1, 1) LEFT JOIN roman n ON n.k = nxt)
SELECT word, variant, string_agg(s, '' ORDER BY i) AS roman FROM spelt GROUP BY word, variant"""


def text_ruby(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("a")
    printed = F.when(F.length("word") % 5 == 0, F.concat("annotated", F.lit("（わ）"))).when(
        F.length("word") % 5 == 1, F.concat("annotated", F.lit("・"), "annotated")).otherwise(F.col("annotated"))
    rows = B.kana_words(spark, sf).withColumn("a", printed)
    branch = X.branches(a)
    return rows.select(
        "word", a.alias("annotated"), X.annotation_ok(a).alias("ok"), X.plain_surface(a).alias("plain"),
        X.word_length(a).alias("n_word"), X.reading_length(a).alias("n_reading"),
        X.generated_reading(a).alias("generated"), X.full_reading(a).alias("full"),
        X.ruby_bracket(a).alias("bracket"), X.ruby_html(a).alias("html"),
        F.size(F.filter(X.segments(a), lambda s: s["source"] == "generated")).alias("n_ruby"),
        F.coalesce(F.array_join(F.transform(branch, lambda b: b["surface"]), "|"), F.lit("")).alias("branch_surfaces"))


_A = """CASE length(word) % 5 WHEN 0 THEN annotated || '（わ）' WHEN 1 THEN annotated || '・' || annotated ELSE annotated END"""
_RUNS = "regexp_extract_all(word, '[^aeiou]+')"
TEXT_RUBY_SQL = f"""WITH {B.KANA_SQL},
x AS (SELECT word, surface, reading, {_A} AS a, length(word) % 5 AS m, len({_RUNS}) AS runs FROM kana)
SELECT word, a AS annotated, true AS ok,
  CASE m WHEN 0 THEN surface || '（わ）' WHEN 1 THEN surface || '・' || surface ELSE surface END AS plain,
  CASE m WHEN 1 THEN 2 * length(surface) + 1 ELSE length(surface) END AS n_word,
  CASE m WHEN 0 THEN length(reading) + 1 WHEN 1 THEN 2 * length(reading) + 1 ELSE length(reading) END AS n_reading,
  CASE m WHEN 0 THEN reading || 'わ' WHEN 1 THEN reading || reading ELSE reading END AS generated,
  CASE m WHEN 0 THEN reading || 'わ' WHEN 1 THEN reading || reading ELSE reading END AS "full",
  ltrim(regexp_replace(a, '([\\x{{4E00}}-\\x{{9FFF}}]+)\\(([^)]*)\\)', ' \\1[\\2]', 'g'), ' ') AS bracket,
  regexp_replace(a, '([\\x{{4E00}}-\\x{{9FFF}}]+)\\(([^)]*)\\)', '<ruby>\\1<rt>\\2</rt></ruby>', 'g') AS html,
  CASE m WHEN 1 THEN 2 * runs ELSE runs END AS n_ruby,
  CASE m WHEN 1 THEN surface || '|' || surface ELSE surface END AS branch_surfaces
FROM x"""


def text_senses(spark: SparkSession, sf: str) -> DataFrame:
    """Sense syntax of every document: its lines are the senses, its sentences the answer."""
    t = F.col("text")
    answer = X.clean_answer(F.split(t, "\n", -1))
    return B.documents(spark, sf).select(
        "doc_id", F.size(X.senses(t)).alias("n_senses"), F.md5(X.first_sense(t)).alias("first"),
        X.has_boundary_semicolon(t).alias("boundary"), answer.isNotNull().alias("accepted"),
        F.md5(F.regexp_replace(t, r"[()（）\[\],·/ \n]+", "")).alias("compared"),
        F.exists(F.split(t, "\n", -1), lambda x: x.rlike("[(（][^)）]*[)）]")).alias("bracketed"), X.has_digit(t).alias("digits"))


_STRIP = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}\x{85}]+"
TEXT_SENSES_SQL = f"""WITH s AS (
  SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{_STRIP}|{_STRIP}$', '', 'g')) AS l FROM documents),
n AS (SELECT *, list_filter(l, lambda x: x <> '') AS f, list_transform(l, lambda x: regexp_replace(regexp_replace(x, '\\.+$', ''), '^{_STRIP}|{_STRIP}$', '', 'g')) AS a FROM s),
m AS (SELECT doc_id, 'T' AS src, i, p[i] AS c FROM (SELECT doc_id, regexp_extract_all(text, '[(（\\[［)）\\]］;]') AS p FROM documents) q, unnest(range(1, len(p) + 1)) AS u(i)),
ml AS (SELECT doc_id, j, i, p[i] AS c FROM (SELECT doc_id, j, regexp_extract_all(a[j], '[(（\\[［)）\\]］;]') AS p FROM n, unnest(range(1, len(a) + 1)) AS v(j)) q, unnest(range(1, len(p) + 1)) AS u(i)),
d AS (SELECT *, sum(CASE WHEN c IN ('(', '（', '[', '［') THEN 1 WHEN c = ';' THEN 0 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
e AS (SELECT *, run - least(0, min(run) OVER (PARTITION BY doc_id ORDER BY i)) AS depth FROM d),
dl AS (SELECT *, sum(CASE WHEN c IN ('(', '（', '[', '［') THEN 1 WHEN c = ';' THEN 0 ELSE -1 END) OVER (PARTITION BY doc_id, j ORDER BY i) AS run FROM ml),
el AS (SELECT *, run - least(0, min(run) OVER (PARTITION BY doc_id, j ORDER BY i)) AS depth FROM dl),
b AS (SELECT DISTINCT doc_id FROM e WHERE c = ';' AND depth = 0),
bl AS (SELECT DISTINCT doc_id FROM el WHERE c = ';' AND depth = 0)
SELECT n.doc_id, len(f) AS n_senses, md5(coalesce(f[1], '')) AS "first", b.doc_id IS NOT NULL AS boundary,
  len(a) <= 3 AND len(list_filter(a, lambda x: x = '' OR regexp_matches(x, '[(（][^)）]*[)）]'))) = 0 AND bl.doc_id IS NULL AS accepted,
  md5(regexp_replace(text, '[()（）\\[\\],·/ \\n]+', '', 'g')) AS compared,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[(（][^)）]*[)）]'))) > 0 AS bracketed,
  regexp_matches(text, '[0-9０-９]') AS digits
FROM n LEFT JOIN b ON b.doc_id = n.doc_id LEFT JOIN bl ON bl.doc_id = n.doc_id"""


QUERIES = {
    "text_fold_kinds": text_fold_kinds, "sound_variants": sound_variants, "text_ruby": text_ruby, "text_senses": text_senses,
}
ORACLES = {
    "text_fold_kinds": FOLD_KINDS_SQL, "sound_variants": SOUND_SQL, "text_ruby": TEXT_RUBY_SQL, "text_senses": TEXT_SENSES_SQL,
}
