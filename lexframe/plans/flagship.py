"""Flagship: for each language and frequency band, the top words and a verified example of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators.order import top_k
from lexframe.plans import base as B

CUTS = [(9, "rare"), (99, "common")]


def flagship_examples(spark: SparkSession, sf: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(B.WORD), F.lit(0)))
    freq = B.words(spark, sf).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("freq"))
    banded = freq.withColumn("band", X.band(F.col("freq"), CUTS, "frequent"))
    best = top_k(banded, ["lang", "band"], [F.desc("freq"), F.asc("word")], 3)
    rows = B.sentences(spark, sf)
    # three words of each language and band: sentences are never dealt by word, of which few hold them all
    # sentence order: number of words, length, then source position
    examples = rows.select(
        "lang", "doc_id", "sent", "text", F.size(F.regexp_extract_all("text", F.lit(B.WORD), F.lit(0))).alias("n_words"),
        F.explode(found).alias("word"),
    ).join(F.broadcast(best.select("lang", "word")), ["lang", "word"], "left_semi")
    shortest = examples.groupBy("lang", "word").agg(
        F.min(F.struct("n_words", F.length("text").alias("n"), "doc_id", "sent", "text")).alias("e"))
    text = F.col("e.text")
    broken = F.when(text.rlike("[|<>]"), 1).otherwise(0) + F.when(F.length(text) > 200, 1).otherwise(0)
    return best.join(shortest, ["lang", "word"], "left").select(
        "lang", "band", "rank", "word", "freq", F.col("e.doc_id").alias("doc_id"), F.col("e.sent").alias("sent"),
        text.alias("example"), broken.alias("violations"))


QUERIES = {"flagship_examples": flagship_examples}
ORACLES = {
    "flagship_examples": f"""WITH {B.WORDS_SQL}, {B.SENTENCES_SQL},
freq AS (SELECT lang, word, count(*) AS freq,
  CASE WHEN count(*) <= 9 THEN 'rare' WHEN count(*) <= 99 THEN 'common' ELSE 'frequent' END AS band
  FROM words GROUP BY lang, word),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, band ORDER BY freq DESC, word) AS rank FROM freq
  QUALIFY row_number() OVER (PARTITION BY lang, band ORDER BY freq DESC, word) <= 3),
cand AS (SELECT s.*, len(regexp_extract_all(s.text, '{B.WORD}')) AS n_words, unnest(list_distinct(regexp_extract_all(lower(s.text), '{B.WORD}'))) AS word FROM sentences s),
ex AS (SELECT c.*, row_number() OVER (PARTITION BY c.lang, c.word ORDER BY n_words, length(text), doc_id, sent) AS rn
  FROM cand c JOIN best b ON b.lang = c.lang AND b.word = c.word)
SELECT b.lang, b.band, b.rank, b.word, b.freq, e.doc_id, e.sent, e.text AS example,
  CASE WHEN regexp_matches(e.text, '[|<>]') THEN 1 ELSE 0 END + CASE WHEN length(e.text) > 200 THEN 1 ELSE 0 END AS violations
FROM best b LEFT JOIN ex e ON e.lang = b.lang AND e.word = b.word AND e.rn = 1"""
}
