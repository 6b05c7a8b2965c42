"""Groups of spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words, the one that comes first (shorter, or equal length and smaller) is cut into two
disjoint chunks, its halves; the other gives all its positional grams of the chunks' lengths. One
edit touches one chunk at most, so the other chunk is a gram, at its own place or shifted by one:
words are joined by (gram, place) within that shift, and the pairs verified by edit distance. A gram
that very many words hold is dealt over salts, and the few chunks that ask for it are copied.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexframe.llm.common import checkpointed, let, lower_ascii, named

# --- fixed values: the letters of a word ---
LETTERS = r"A-Za-zÀ-ÿ"
#: code points and occurrences that a word needs
LENGTH, OCCURRENCES = 6, 5
#: a word's form occurs at least so many times as often
RATIO = 5
#: one in so many runs (by crc32 of ``<id>:<run>``) loses a letter
EVERY = 199
#: words that share a gram at a place are dealt in lots of this many
LOT = 2000


def damaged(key: Column, run: Column) -> Column:
    """The run, or, where its crc32 with the key is a multiple of EVERY, the run without one letter."""

    def without(h: Column) -> Column:
        at = F.pmod(h, F.length(run).cast("long")).cast("int")
        return F.when(F.pmod(h, F.lit(EVERY)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)

    return let(F.crc32(F.concat(key, F.lit(":"), run)), without)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): every word of all texts with at least so many code points and occurrences."""
    # a run shorter than a word gives none, so only runs of that many letters are taken out
    runs = F.regexp_extract_all(lower_ascii(named(text)), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(named(key).cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("run"))
    words = runs.select(damaged(F.col("k"), F.col("run")).alias("word")).where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def near_pairs(words: DataFrame, lot: int = LOT) -> DataFrame:
    """(a, b): every two of the distinct ``words`` (word) that differ by exactly one edit, once."""
    sized = words.select("word", F.length("word").alias("size"))
    half = (F.col("size") / 2).cast("int")
    chunk = F.array(
        F.struct(F.substring("word", F.lit(1), half).alias("gram"), F.lit(0).alias("at")),
        F.struct(F.substring("word", half + 1, F.col("size")).alias("gram"), half.alias("at")),
    )
    # the longer word holds a chunk where the chunk stands, or one further
    chunks = sized.select(F.col("word").alias("a"), F.col("size").alias("n_a"), F.inline(chunk)).where("gram <> ''")
    chunks = chunks.withColumn("at", F.explode(F.array(F.col("at"), F.col("at") + 1)))

    def grams_of(q: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.col("size") - q, F.lit(0)))
        found = F.transform(places, lambda at: F.struct(F.substring("word", at + 1, q).alias("gram"), at.alias("at")))
        return F.when((q > 0) & (q <= F.col("size")), found).otherwise(F.array().cast("array<struct<gram:string,at:int>>"))

    # the chunks of a word of this length or one letter less
    lengths = F.array_distinct(F.flatten(F.transform(F.array(F.col("size"), F.col("size") - 1), lambda n: F.array((n / 2).cast("int"), n - (n / 2).cast("int")))))
    grams = sized.select(F.col("word").alias("b"), F.col("size").alias("n_b"), F.inline(F.flatten(F.transform(lengths, grams_of))))
    hot = grams.groupBy("gram", "at").agg(F.ceil(F.count(F.lit(1)) / lot).cast("int").alias("lots"))
    # only places that some chunk asks for are looked at, and only crowded ones are dealt
    asked = chunks.join(hot, ["gram", "at"])
    asked = asked.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    crowded = hot.where("lots > 1").withColumnRenamed("gram", "g").withColumnRenamed("at", "p")
    dealt = grams.join(crowded, (F.col("gram") == F.col("g")) & (F.col("at") == F.col("p")), "left")
    dealt = dealt.select("b", "n_b", F.col("gram").alias("g"), F.col("at").alias("p"), F.coalesce(F.pmod(F.xxhash64("b"), F.col("lots")), F.lit(0)).cast("int").alias("l"))
    first = ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))) | (F.col("n_a") + 1 == F.col("n_b"))
    met = asked.join(dealt, (F.col("gram") == F.col("g")) & (F.col("at") == F.col("p")) & (F.col("lot") == F.col("l")) & first)
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
    length: int = LENGTH, occurrences: int = OCCURRENCES, ratio: int = RATIO,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a row per word of all texts.

    A word's form is the most frequent of its near words (ties: the smallest), if that is at least
    ``ratio`` times as frequent as the word, else null; the root follows the forms to the last. Null
    and empty texts have no words; a null id counts as an empty one in the damage; repeated rows
    count again. Without words the result is empty. Other columns are not read.
    """
    words = checkpointed(vocabulary(docs, key, text, length, occurrences))
    pairs = checkpointed(near_pairs(words))
    both = pairs.union(pairs.select("b", "a"))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    best = counted.groupBy("a").agg(F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best"))
    best = best.select(F.col("a").alias("word"), "near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))
    joined = words.join(best, "word", "left")
    is_form = F.col("best_n") >= F.col("n") * ratio
    formed = checkpointed(
        joined.select(
            "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
        )
    )
    # frequencies along the forms grow by the ratio, so their number is bounded; each round doubles the reach
    most = formed.agg(F.max("form_n")).first()[0] or 1
    steps = int(math.log(max(most / occurrences, 1), ratio)) + 1
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        onward = roots.toDF("via", "next")
        roots = roots.join(onward, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS crc),
r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS k,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT k, run, count(*) AS m, encode(k || ':' || run) AS bytes FROM r GROUP BY ALL),
h AS (
  SELECT run, m, xor(list_reduce(list_transform(range(0, octet_length(bytes)), lambda i: ('0x' || substr(hex(bytes), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h FROM d, t),
o AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, m FROM h),
w AS MATERIALIZED (SELECT word, sum(m)::BIGINT AS n FROM o WHERE length(word) >= {LENGTH} GROUP BY word HAVING sum(m) >= {OCCURRENCES}),
x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, w.word FROM x JOIN w ON x.less = w.word UNION SELECT w.word, x.word FROM x JOIN w ON x.less = w.word),
b AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS best_n FROM p JOIN w ON w.word = p.b GROUP BY a),
g AS (SELECT p.a AS word, min(p.b) AS best FROM p JOIN w ON w.word = p.b JOIN b ON b.word = p.a AND w.n = b.best_n GROUP BY p.a),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= {RATIO} * w.n THEN best END AS form, CASE WHEN best_n >= {RATIO} * w.n THEN best_n END AS form_n
  FROM w LEFT JOIN b USING (word) LEFT JOIN g USING (word)),
c AS (SELECT word, word AS root, 0 AS depth FROM f UNION ALL SELECT c.word, f.form, depth + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, max_by(root, depth) AS root FROM c GROUP BY word) USING (word)"""
