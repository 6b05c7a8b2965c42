"""The three dataset shapes built from words and sentences, through their specs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import search as S
from lexframe.operators.stats import TAGS
from lexframe.plans import base as B
from lexframe.spec import GRAMMAR, KANJI, VOCAB

_EXAMPLE = "struct<w:string,ko:string>"


def _kanji(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("word")
    example = F.array(F.struct(F.when(n % 7 == 0, F.col("surface")).otherwise(F.col("annotated")).alias("w"), F.when(n % 5 == 0, F.lit(" a;b")).otherwise(F.col("word")).alias("ko")))
    return B.kana_words(spark, sf).select(
        F.when(n % 9 == 0, F.col("surface")).otherwise(F.left("surface", F.lit(1))).alias("key"),
        F.when(n % 8 == 0, F.lit("zz")).otherwise(F.element_at(F.array(*[F.lit(t) for t in TAGS]), (n % 8).cast("int"))).alias("tag"),
        F.when(n % 6 == 0, F.create_map(F.lit("亜亜"), F.lit("bad"))).otherwise(F.expr("cast(map() as map<string,string>)")).alias("variant"),
        F.when(n % 4 == 0, F.create_map(F.lit("ん"), example)).otherwise(F.expr(f"cast(map() as map<string,array<{_EXAMPLE}>>)")).alias("except"),
        F.create_map(F.when(n % 3 == 0, F.lit("カひ")).otherwise(X.kana_unfold(F.col("reading"))), example).alias("readings"),
        F.create_map(F.when(n % 10 == 0, F.lit("x")).otherwise(F.lit("본")), F.array(F.lit("g"))).alias("korean"),
        F.when(n % 2 == 0, F.lit("gemini")).alias("korean_src"), F.expr("cast(null as array<struct<kind:string,of:string,word:string,reading:string,written:string,words:array<string>,body:string>>)").alias("note"))


def kanji_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Violations of every word's record, counted per rule."""
    return KANJI.contract(_kanji(spark, sf)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


KANJI_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n, regexp_matches(word, '[^aeiou]') AS based, contains(reading, 'ん') AS has_n FROM kana),
v AS (SELECT * FROM k WHERE n % 9 <> 0 OR length(surface) = 1), e AS (SELECT *, 1 AS b FROM v UNION ALL SELECT *, 2 FROM v WHERE n % 4 = 0)
SELECT * FROM (SELECT 'key not one character' AS rule, count(*) AS n FROM k WHERE n % 9 = 0 AND length(surface) > 1
UNION ALL SELECT 'unknown tag', count(*) FROM v WHERE n % 8 = 0
UNION ALL SELECT 'variant not one character', count(*) FROM v WHERE n % 6 = 0 UNION ALL SELECT 'unknown variant label', count(*) FROM v WHERE n % 6 = 0
UNION ALL SELECT 'readings key', count(*) FROM v WHERE n % 3 = 0
UNION ALL SELECT 'untrimmed ko', count(*) FROM e WHERE n % 5 = 0 UNION ALL SELECT 'semicolon between senses', count(*) FROM e WHERE n % 5 = 0
UNION ALL SELECT 'blank or untrimmed sense', count(*) FROM e WHERE n % 5 = 0
UNION ALL SELECT 'annotation does not parse', count(*) FROM e WHERE n % 7 = 0 AND based
UNION ALL SELECT 'exception reading not contained', count(*) FROM v WHERE n % 4 = 0 AND NOT has_n AND NOT (n % 7 = 0 AND based)
UNION ALL SELECT 'gloss form not a variant', count(*) FROM v WHERE n % 10 = 0 UNION ALL SELECT 'no main gloss form', count(*) FROM v WHERE n % 10 = 0) WHERE n > 0"""


def kanji_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted and projected records with their term index and notes, summed per first character."""
    df = KANJI.sort(_kanji(spark, sf).where("length(key) = 1"))
    shown = KANJI.project(df).groupBy("key").agg(
        F.count(F.lit(1)).alias("records"), F.sum("example_count").alias("examples"), F.sum("annotation_warnings").alias("warnings"), F.max("codepoint").alias("codepoint"))
    terms = KANJI.terms(df).groupBy("key").agg(F.count(F.lit(1)).alias("terms"), F.count_if(F.col("kind") == "reading_alias").alias("aliases"))
    notes = KANJI.notes[0].build(df).groupBy(F.substring("key", 7, 1).alias("key")).agg(F.count_if(F.element_at("placement", F.lit("읽기")).endswith("9. 기타")).alias("unplaced"))
    return shown.join(terms, "key").join(notes, "key")


PROJECT_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n, regexp_matches(word, '[^aeiou]') AS based, surface[1] AS key FROM kana WHERE length(word) % 9 <> 0 OR length(word) = 1)
SELECT key, count(*) AS records, CAST(sum(CASE WHEN n % 4 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS examples,
  CAST(sum(CASE WHEN (n % 7 = 0 AND based) OR (n % 3 = 0 AND NOT contains(reading, 'かひ')) THEN 1 ELSE 0 END) AS BIGINT) AS warnings,
  'U+' || upper(printf('%04x', unicode(key))) AS codepoint,
  CAST(sum(1 + CASE WHEN n % 6 = 0 THEN 2 ELSE 0 END + 1 + CASE WHEN n % 8 = 0 THEN 0 ELSE 1 END + CASE WHEN n % 10 = 0 THEN 2 ELSE 1 END + 2 + 3 + CASE WHEN n % 4 = 0 THEN 4 ELSE 0 END + CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS terms,
  count(*) AS aliases, count(*) FILTER (n % 8 = 0) AS unplaced
FROM k GROUP BY key"""


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("word")
    sense = F.struct(F.when(n % 4 == 0, F.concat(F.col("surface"), F.lit("("))).otherwise(F.col("annotated")).alias("ja"), F.when(n % 5 == 0, F.lit("odd")).otherwise("noun").alias("pos"),
                     F.lit("g").alias("gloss"), F.col("word").alias("en"), F.when(n % 3 == 0, F.lit("unsure")).otherwise("jmdict").alias("checked"),
                     F.when(n % 2 == 0, F.struct(F.when(n % 6 == 0, F.lit("")).otherwise(F.col("word")).alias("en"), F.col("annotated").alias("ja"))).alias("example"))
    return B.kana_words(spark, sf).select(
        F.col("word").alias("key"), F.lit("ngsl").alias("list"), F.col("freq").cast("int").alias("rank"), F.when(n % 7 == 0, F.lit("?")).otherwise("1-1000").alias("band"),
        F.array("word", F.concat("word", F.lit("S"))).alias("family"), F.array(sense, sense).alias("senses"))


def vocab_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Violations, unverified senses and terms of the vocabulary shape, per word."""
    df = _vocab(spark, sf)
    broken = VOCAB.contract(df).groupBy("key").agg(F.count(F.lit(1)).alias("broken"))
    shown = VOCAB.project(df).select("key", "unverified", F.col("senses")[1]["plain"].alias("plain"), "band_label")
    terms = VOCAB.terms(df).groupBy("key").agg(F.count(F.lit(1)).alias("terms"), F.max("weight").alias("weight"))
    return shown.join(broken, "key", "left").join(terms, "key").select("key", "unverified", "plain", "band_label", F.coalesce("broken", F.lit(0)).alias("broken"), "terms", "weight")


VOCAB_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n FROM kana)
SELECT word AS key, CASE WHEN n % 3 = 0 THEN 2 ELSE 0 END AS unverified, CASE WHEN n % 4 = 0 THEN surface || '(' ELSE surface END AS plain,
  CASE WHEN n % 7 = 0 THEN '' ELSE 'NGSL 1-1000' END AS band_label,
  CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END + 2 * (CASE WHEN n % 4 = 0 AND regexp_matches(word, '[^aeiou]') THEN 1 ELSE 0 END + CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN n % 6 = 0 THEN 1 ELSE 0 END) AS broken,
  1 + 1 + 8 + 1 AS terms, -freq AS weight FROM k"""


def grammar_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences grouped by document as grammar records: violations, projection and example notes."""
    marked = F.when(F.col("sent") % 5 == 0, F.concat(F.lit("*"), F.translate("text", "*", ""))).when(F.col("sent") % 3 == 0, F.concat(F.lit("*"), F.translate("text", "*", ""), F.lit("*"))).otherwise(F.lit(""))
    rows = B.sentences(spark, sf).select("doc_id", F.struct("sent", F.translate("text", "*", "").alias("ja"), marked.alias("marked"),
                                         F.lit("k").alias("ko"), F.when(F.col("sent") % 3 == 0, F.lit("human")).alias("mark_method")).alias("x"))
    df = rows.groupBy(F.col("doc_id").cast("string").alias("key")).agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x.dropFields("sent")).alias("examples")).select(
        "key", F.concat(F.lit("h"), "key").alias("head"), F.right("key", F.lit(1)).alias("level"), F.lit("m").alias("gloss_ko"), F.lit(None).cast("string").alias("note_ko"),
        F.lit(None).cast("string").alias("gloss_ja"), F.lit(None).cast("string").alias("gloss_en"), F.array(F.lit("Ｖて")).alias("connect"), "examples")
    broken = GRAMMAR.contract(df).groupBy("key").agg(F.count_if(F.col("rule") == "unpaired marks").alias("unpaired"))
    shown = GRAMMAR.project(df).select("key", "level", "unmarked", F.size("examples").alias("n"))
    notes = GRAMMAR.notes[1].build(df).groupBy(F.split_part("key", F.lit(":"), F.lit(2)).alias("key")).agg(F.count(F.lit(1)).alias("notes"))
    terms = GRAMMAR.terms(df).groupBy("key").agg(F.count_if(F.col("kind") == "span").alias("spans"))
    return shown.join(broken, "key", "left").join(notes, "key").join(terms, "key").select("key", "level", "unmarked", "n", F.coalesce("unpaired", F.lit(0)).alias("unpaired"), "notes", "spans")


GRAMMAR_ORACLE = f"""WITH {B.SENTENCES_SQL}, s AS (SELECT doc_id, sent, text, sent % 5 = 0 AS odd, sent % 5 <> 0 AND sent % 3 = 0 AS good, replace(text, '*', '') AS plain FROM sentences)
SELECT CAST(doc_id AS VARCHAR) AS key, CASE doc_id % 10 WHEN 1 THEN 'N1' WHEN 2 THEN 'N2' WHEN 3 THEN 'N4' WHEN 4 THEN 'N5' ELSE '' END AS level, count(*) FILTER (sent % 3 <> 0) AS unmarked, count(*) AS n,
  count(*) FILTER (odd) AS unpaired, count(*) AS notes, count(*) FILTER (good AND regexp_replace(plain, '\\([^)]*\\)', '', 'g') <> '') AS spans FROM s GROUP BY doc_id"""


def kanji_search(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark readings searched in the vocabulary terms, best forty per query."""
    terms = VOCAB.terms(_vocab(spark, sf))
    asked = B.benchmark_words(spark, sf).select(F.col("word").alias("qid"), F.upper("word").alias("query"))
    return S.search(terms, asked, VOCAB.ranks, 40).select("qid", "place", "key", "match_kind", "exact", "total")


SEARCH_ORACLE = f"""WITH {B.KANA_SQL}, {B.BENCHMARK_SQL}, q AS MATERIALIZED (SELECT word AS q, {B.fold_sql('word')} AS qf FROM benchmark_words),
t0 AS (SELECT word AS key, freq, o, CASE o WHEN 0 THEN word WHEN 1 THEN word || 's' ELSE word END AS t, CASE o WHEN 0 THEN 'key' WHEN 1 THEN 'family' ELSE 'en' END AS kind FROM kana, (VALUES (0), (1), (2)) v(o)),
t AS MATERIALIZED (SELECT *, {B.fold_sql('t')} AS tf FROM t0),
m AS (SELECT q, t.*, CASE WHEN tf = qf THEN CASE kind WHEN 'key' THEN 0 WHEN 'family' THEN 1 ELSE 3 END ELSE 10 END AS r FROM q JOIN t ON contains(tf, qf)),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY q, key ORDER BY r, o) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY r, -freq DESC, key) AS place, count(*) OVER (PARTITION BY q) AS total FROM b)
SELECT q AS qid, place, key, kind AS match_kind, r < 10 AS exact, total FROM p WHERE place <= 40"""

QUERIES = {"kanji_contract": kanji_contract, "kanji_projection": kanji_projection, "vocab_dataset": vocab_dataset, "grammar_dataset": grammar_dataset, "vocab_search": kanji_search}
ORACLES = {"kanji_contract": KANJI_ORACLE, "kanji_projection": PROJECT_ORACLE, "vocab_dataset": VOCAB_ORACLE, "grammar_dataset": GRAMMAR_ORACLE, "vocab_search": SEARCH_ORACLE}
