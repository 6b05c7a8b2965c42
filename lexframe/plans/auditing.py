"""Statistics, order, guards and audits over words, orders, line items, labels and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import audit as A, attribute as T, curate as C, guards as G, order as O, select as S, stats as ST
from lexframe.plans import base as B
from lexframe.session import table


def _nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One record per order: maps of line numbers per return flag, split by line status."""
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linestatus", "l_returnflag").agg(F.collect_list("l_linenumber").alias("n"))
    def side(status: str):
        return F.map_from_entries(F.collect_list(F.when(F.col("l_linestatus") == status, F.struct("l_returnflag", "n"))))
    maps = items.groupBy("l_orderkey").agg(side("O").alias("readings"), side("F").alias("except"))
    o = table(spark, sf, "orders")
    tag = F.element_at(F.array(*[F.lit(t) for t in ST.TAGS]), F.substring("o_orderpriority", 1, 1).cast("int"))
    return o.join(maps, o.o_orderkey == maps.l_orderkey).select(
        "o_orderkey", tag.alias("tag"), "readings", "except", F.when(F.col("o_orderstatus") == "P", F.create_map(F.lit("x"), F.lit("y"))).otherwise(F.expr("map()").cast("map<string,string>")).alias("variant"))


def stats_records(spark: SparkSession, sf: str) -> DataFrame:
    return ST.stats_kanji(_nested_orders(spark, sf))


STATS_ORACLE = """WITH g AS (SELECT DISTINCT l_orderkey, l_linestatus, l_returnflag FROM lineitem),
o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
i AS (SELECT l.* FROM lineitem l JOIN orders ON o_orderkey = l_orderkey), gg AS (SELECT g.* FROM g JOIN orders ON o_orderkey = l_orderkey)
SELECT 'characters' AS name, count(*) AS value FROM o
UNION ALL SELECT 'readings', count(*) FROM gg WHERE l_linestatus = 'O'
UNION ALL SELECT 'examples', count(*) FROM i
UNION ALL SELECT 'regular_examples', count(*) FROM i WHERE l_linestatus = 'O'
UNION ALL SELECT 'variants', count(*) FROM o WHERE o_orderstatus = 'P'
UNION ALL SELECT 'exception_readings', count(*) FROM gg WHERE l_linestatus = 'F'
UNION ALL SELECT 'exception_examples', count(*) FROM i WHERE l_linestatus = 'F'
UNION ALL SELECT 'tag ' || t.t, count(o.o_orderkey) FROM (VALUES ('s1', '1'), ('s2', '2'), ('s3', '3'), ('s4', '4'), ('s5', '5'), ('s6', '6'), ('j', '7'), ('h', '8')) t(t, d)
  LEFT JOIN o ON o.o_orderpriority[1] = t.d GROUP BY t.t"""


def stats_words(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary and grammar statistics over document sentences, with reading groups."""
    rows = B.sentences(spark, sf).withColumn("w", F.regexp_extract_all("text", F.lit(B.WORD), F.lit(0)))
    n = F.size("w")
    vocab = rows.select(
        F.when(n <= 5, "1-1000").when(n <= 10, "1001-2000").otherwise("TSL").alias("band"),
        F.transform("w", lambda x: F.struct(F.when(F.length(x) > 8, "jmdict").when(F.length(x) > 4, "phrase").otherwise("unsure").alias("checked"), F.when(x.rlike("^[A-Z]"), x).alias("example"))).alias("senses"))
    grammar = rows.select(
        (n % 6).cast("string").alias("level"),
        F.transform("w", lambda x: F.struct(F.when(x.rlike("e$"), x).otherwise("").alias("ko"), F.when(x.rlike("n$"), x).alias("mark_method"))).alias("examples"))
    groups = ST.reading_groups(B.kana_words(spark, sf).select(F.when(F.length("word") % 2 == 0, X.kana_unfold(F.col("reading"))).otherwise(F.concat("reading", F.lit("ー"))).alias("r")), "r")
    def named(part: str, df: DataFrame) -> DataFrame:
        return df.select(F.concat(F.lit(part), "name").alias("name"), "value")
    return named("v ", ST.stats_vocab(vocab)).unionByName(named("g ", ST.stats_grammar(grammar))).unionByName(groups.select(F.concat(F.lit("r "), "kind").alias("name"), F.col("n").alias("value")))


STATS_WORDS_ORACLE = f"""WITH {B.KANA_SQL}, {B.SENTENCES_SQL}, s AS (SELECT regexp_extract_all(text, '{B.WORD}') AS w FROM sentences), n AS (SELECT w, len(w) AS n FROM s), u AS (SELECT unnest(w) AS x FROM s)
SELECT 'v records' AS name, count(*) AS value FROM n UNION ALL SELECT 'v senses', count(*) FROM u
UNION ALL SELECT 'v examples', count(*) FROM u WHERE regexp_matches(x, '^[A-Z]') UNION ALL SELECT 'v empty', count(*) FROM n WHERE n = 0
UNION ALL SELECT 'v band 1-1000', count(*) FROM n WHERE n <= 5 UNION ALL SELECT 'v band 1001-2000', count(*) FROM n WHERE n BETWEEN 6 AND 10
UNION ALL SELECT 'v band 2001-2809', 0 UNION ALL SELECT 'v band TSL', count(*) FROM n WHERE n > 10
UNION ALL SELECT 'v checked jmdict', count(*) FROM u WHERE length(x) > 8 UNION ALL SELECT 'v checked phrase', count(*) FROM u WHERE length(x) BETWEEN 5 AND 8
UNION ALL SELECT 'v checked unsure', count(*) FROM u WHERE length(x) <= 4
UNION ALL SELECT 'g records', count(*) FROM n UNION ALL SELECT 'g examples', count(*) FROM u
UNION ALL SELECT 'g translated', count(*) FROM u WHERE x LIKE '%e' UNION ALL SELECT 'g marked', count(*) FROM u WHERE x LIKE '%n'
UNION ALL SELECT 'g level N1', count(*) FROM n WHERE n % 6 = 1 UNION ALL SELECT 'g level N2', count(*) FROM n WHERE n % 6 = 2
UNION ALL SELECT 'g level N4', count(*) FROM n WHERE n % 6 = 3 UNION ALL SELECT 'g level N5', count(*) FROM n WHERE n % 6 = 4
UNION ALL SELECT 'r on', count(*) FROM kana WHERE length(word) % 2 = 0 UNION ALL SELECT 'r verb', count(*) FROM kana WHERE length(word) % 2 = 1"""


def stats_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage per language, sense histogram and a dataset summary with its overlay."""
    t = F.col("text")
    docs = table(spark, sf, "documents")
    cover = ST.coverage(docs, {"dotted": t.contains("."), "digits": X.has_digit(t)}, ["lang"])
    flat = cover.select(F.concat_ws(" ", F.lit("cover"), "lang").alias("name"), (F.col("dotted") * 1000000 + F.col("digits")).alias("value"))
    histogram = ST.histogram(docs, F.size(X.senses(t))).select(F.concat(F.lit("senses "), F.col("bin").cast("string")).alias("name"), F.col("n").alias("value"))
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.struct("c_name", "c_mktsegment").alias("record"))
    r = F.col("record")
    overlay = base.where("key % 4 = 0").select("key", F.when(F.col("key") % 8 == 0, r).otherwise(r.withField("c_name", F.lit("x"))).alias("human"), r.alias("baseline"), F.lit(2).cast("long").alias("revision"))
    stats = base.groupBy(F.concat(F.lit("segment "), "record.c_mktsegment").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    # the overlay was made on a base in which some names were others, except where there are no such customers
    was = base.withColumn("record", F.when(F.col("key") % 500 == 7, r.withField("c_name", F.lit("old"))).otherwise(r))
    roots = [C.fingerprint_root(C.fingerprint_tree(b)) for b in (base, was)]
    return ST.summary(stats, overlay, *roots).unionByName(flat).unionByName(histogram)


_SP = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}\x{85}]"
SUMMARY_ORACLE = f"""SELECT 'segment ' || c_mktsegment AS name, count(*) AS value FROM customer GROUP BY ALL
UNION ALL SELECT 'edited', count(*) FROM customer WHERE c_custkey % 8 = 4 UNION ALL SELECT 'overlay_revision', 2 * count(*) FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT 'base_rows', count(*) FROM customer UNION ALL SELECT 'overlay_conflict', CAST(count(*) FILTER (c_custkey % 500 = 7) > 0 AS INT) FROM customer
UNION ALL SELECT 'cover ' || lang, CAST(floor(count(*) FILTER (contains(text, '.')) * 1000000.0 / count(*)) * 1000000 + floor(count(*) FILTER (regexp_matches(text, '[0-9０-９]')) * 1000000.0 / count(*)) AS BIGINT) FROM documents GROUP BY lang
UNION ALL SELECT 'senses ' || n, count(*) FROM (SELECT len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{_SP}+', '') <> '')) AS n FROM documents) GROUP BY n"""


def ordered_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Line items merged per part in source order, each return flag kept at its first place."""
    items = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("src"), "l_suppkey")
    chunk = F.floor(F.col("src") / 4096)
    merged = S.merge_rows(items, ["l_partkey"], ["src", "l_suppkey", "l_returnflag"], chunk).groupBy("l_partkey").agg(F.max("ord").alias("n"), F.max(F.struct("ord", "src"))["src"].alias("last"))
    first = S.ordered_distinct(items, ["l_partkey"], "l_returnflag", ["src"], chunk).where("ord = 1").select("l_partkey", F.col("l_returnflag").alias("flag"))
    vector = T.best_vector(items.select("l_partkey", (F.col("src") % 7).alias("score"), "l_returnflag"), ["l_partkey"], "score", "l_returnflag")
    return merged.join(first, "l_partkey").join(vector, "l_partkey")


MERGE_ORACLE = """WITH i AS (SELECT l_partkey, l_returnflag, l_orderkey * 10 + l_linenumber AS src FROM lineitem),
m AS (SELECT l_partkey, max(src % 7) AS score FROM i GROUP BY ALL)
SELECT i.l_partkey, count(*) AS n, max(src) AS last, arg_min(l_returnflag, (src, l_returnflag)) AS flag, any_value(m.score) AS score,
  min(l_returnflag) FILTER (src % 7 = m.score) AS vector, min(l_returnflag) FILTER (src % 7 = m.score) <> max(l_returnflag) FILTER (src % 7 = m.score) AS ambiguous
FROM i JOIN m USING (l_partkey) GROUP BY i.l_partkey"""


def entry_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Homograph-safe keys of the sentences by their first word, in document order."""
    rows = B.sentences(spark, sf).select("doc_id", "sent", F.lower(F.regexp_extract("text", B.WORD, 0)).alias("head"))
    return O.entry_keys(rows, "head", ["doc_id", "sent"], F.floor(F.col("doc_id") / 64)).select("doc_id", "sent", "key")


KEYS_ORACLE = f"""WITH {B.SENTENCES_SQL}, h AS (SELECT doc_id, sent, lower(regexp_extract(text, '{B.WORD}')) AS head FROM sentences),
r AS (SELECT *, row_number() OVER (PARTITION BY head ORDER BY doc_id, sent) AS n FROM h)
SELECT doc_id, sent, CASE WHEN n = 1 THEN head ELSE head || '#' || n END AS key FROM r"""


def display_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Parts laid out two per row inside their brand."""
    parts = table(spark, sf, "part").select("p_brand", "p_partkey")
    return O.display_grid(parts, ["p_brand"], ["p_partkey"], F.floor(F.col("p_partkey") / 4096))


GRID_ORACLE = """WITH p AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
SELECT p_brand, p_partkey, i % 3 AS tone, i // 2 AS "row", i % 2 AS col, i + 1 = n AND i % 2 = 0 AS filler FROM p"""


def inserted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers inserted behind the order they share a number with, then batches of forty."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("name"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), (F.col("s_suppkey") % 50).cast("string").alias("after"), F.col("s_suppkey").alias("seq"))
    out = O.insert_after(o, s, "ord", "name", 4096, "place")
    return O.batch_ids(out, ["place"], F.floor(F.col("place") / 4096), 40)


INSERT_ORACLE = """WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS name, o_orderkey AS a, -1000000000 AS sub FROM orders
  UNION ALL SELECT s_name, o_orderkey, -s_suppkey FROM supplier JOIN orders ON o_orderkey = s_suppkey % 50),
p AS (SELECT name, row_number() OVER (ORDER BY a, sub) AS place FROM b)
SELECT name, place, (place - 1) // 40 AS batch FROM p"""


def sequence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers that do not run 1..n in ship order, minus listed misprints."""
    items = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("number"), F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship"), "l_partkey", "l_suppkey")
    allow = items.where("l_suppkey % 10 = 0").select("l_orderkey", "number")
    return O.check_sequence(items, ["l_orderkey"], ["number", "ship", "l_partkey", "l_suppkey"], F.lit(0), "number", allow).select("l_orderkey", "number", "l_partkey", "expected")


SEQ_ORACLE = """WITH i AS (SELECT l_orderkey, l_linenumber AS number, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS expected FROM lineitem)
SELECT l_orderkey, number, l_partkey, expected FROM i WHERE expected <> number
  AND (l_orderkey, number) NOT IN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 10 = 0)"""


def set_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Guards over order keys: overlap, strays, duplicates, multiset and set differences, stale keys, declared counts."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("s"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("name"), "value")
    union, clash = G.union_lists(o.select("k"), c, "k")
    declared = o.groupBy(F.col("s").alias("key")).agg((F.count(F.lit(1)) + F.when(F.col("s") == "F", 1).otherwise(0)).alias("value"))
    actual = o.groupBy(F.col("s").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    parts = [
        count("overlap", G.overlap_rows(c, o, ["k"])), count("outside", G.outside_rows(o, l, ["k"])),
        count("duplicates", G.duplicate_keys(l, ["k"], "s")), count("multiset", G.multiset_difference(o, l, ["k", "s"])),
        count("set", G.set_difference(o.select("k"), l.select("k"), ["k"])), count("stale", G.stale_keys(o, l, "k")),
        count("common", G.common_values(o, l, ["s"])), count("union", union), count("clash", clash), count("counts", G.expect_counts(actual, declared, "key", "value")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


GUARDS_ORACLE = """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), l AS (SELECT l_orderkey AS k, l_linestatus AS s FROM lineitem), c AS (SELECT c_custkey AS k FROM customer),
ms AS (SELECT k, s, sum(a) AS a, sum(b) AS b FROM (SELECT k, s, 1 AS a, 0 AS b FROM o UNION ALL SELECT k, s, 0, 1 FROM l) GROUP BY ALL)
SELECT 'overlap' AS name, count(*) AS value FROM c WHERE k IN (SELECT k FROM o)
UNION ALL SELECT 'outside', count(*) FROM o WHERE k NOT IN (SELECT k FROM l)
UNION ALL SELECT 'duplicates', count(*) FROM (SELECT k FROM l GROUP BY k HAVING count(*) > 1)
UNION ALL SELECT 'multiset', count(*) FROM ms WHERE a <> b
UNION ALL SELECT 'set', count(*) FROM (SELECT DISTINCT k FROM o) x FULL JOIN (SELECT DISTINCT k FROM l) y ON x.k = y.k WHERE x.k IS NULL OR y.k IS NULL
UNION ALL SELECT 'stale', count(*) FROM o WHERE k NOT IN (SELECT k FROM l)
UNION ALL SELECT 'common', count(*) FROM (SELECT s FROM o INTERSECT SELECT s FROM l)
UNION ALL SELECT 'union', (SELECT count(*) FROM o) + (SELECT count(*) FROM c)
UNION ALL SELECT 'clash', count(*) FROM c WHERE k IN (SELECT k FROM o)
UNION ALL SELECT 'counts', count(*) FROM (SELECT DISTINCT s FROM o WHERE s = 'F')"""


def pair_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Per language and five-letter stem, the first two entries that do not differ enough.

    Some words stand twice: with no reason, with another reason, or with one more sense.
    """
    word, n = F.col("word"), F.length("word")
    words = B.words(spark, sf).select("lang", "word").distinct()
    own = words.select("lang", F.left("word", F.lit(5)).alias("stem"), word.alias("ord"), word.alias("meaning"), F.right("word", F.lit(2)).alias("why"))
    second = words.where(n % 4 != 0).select(
        "lang", F.left("word", F.lit(5)).alias("stem"), F.concat("word", F.lit("~")).alias("ord"),
        F.when(n % 4 == 3, F.concat("word", F.lit("\n0123"))).otherwise(word).alias("meaning"), F.when(n % 4 == 1, F.lit("other")).otherwise(F.lit(" ")).alias("why"))
    return A.compare_pairs(own.unionByName(second), ["lang", "stem"])


PAIR_ORACLE = f"""WITH {B.WORDS_SQL}, w AS (SELECT DISTINCT lang, word FROM words),
r AS (SELECT lang, left(word, 5) AS stem, word AS ord, word AS first, word AS norm, right(word, 2) AS why FROM w
  UNION ALL SELECT lang, left(word, 5), word || '~', word, word || CASE WHEN length(word) % 4 = 3 THEN '0123' ELSE '' END, CASE WHEN length(word) % 4 = 1 THEN 'other' ELSE '' END FROM w WHERE length(word) % 4 <> 0),
s AS (SELECT *, list_distinct(string_split(norm, '')) AS c FROM r),
p AS (SELECT a.lang, a.stem, a.ord AS a, b.ord AS b, a.norm = b.norm AS same, a.first = b.first AS head, a.why <> '' AND b.why <> '' AND a.why <> b.why AS other
  FROM s a JOIN s b ON a.lang = b.lang AND a.stem = b.stem AND a.ord < b.ord
  AND (a.norm = b.norm OR a.first = b.first OR len(list_intersect(a.c, b.c)) >= 0.8 * (len(a.c) + len(b.c) - len(list_intersect(a.c, b.c))) - 1e-9)),
q AS (SELECT lang, stem, arg_min(struct_pack(a := a, b := b, same := same, head := head, other := other), (a, b)) AS p FROM p GROUP BY lang, stem)
SELECT lang, stem, p.a AS a, p.b AS b, CASE WHEN p.same AND NOT p.other THEN 'FAIL' ELSE 'WARN' END AS severity,
  CASE WHEN p.same AND p.other THEN 'same meaning, distinct reasons' WHEN p.same THEN 'same meaning, no reason' WHEN p.head THEN 'same first sense' ELSE 'nearly the same meaning' END AS reason FROM q"""


def audit_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Sense-syntax findings of all documents, tallied with their share."""
    found = A.audit_meanings(B.documents(spark, sf), ["doc_id"], "text")
    return A.tally(found, ["severity", "reason"])


AUDIT_ORACLE = f"""WITH d AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{_SP}+|{_SP}+$', '', 'g')), lambda x: x <> '') AS l FROM documents),
m AS (SELECT doc_id, i, p[i] AS c FROM (SELECT doc_id, regexp_extract_all(text, '[(（\\[［)）\\]］;]') AS p FROM documents) q, unnest(range(1, len(p) + 1)) AS u(i)),
s AS (SELECT *, sum(CASE WHEN c IN ('(', '（', '[', '［') THEN 1 WHEN c = ';' THEN 0 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
e AS (SELECT *, run - least(0, min(run) OVER (PARTITION BY doc_id ORDER BY i)) AS depth FROM s),
f AS (SELECT DISTINCT doc_id, 'FAIL' AS severity, 'semicolon between senses' AS reason FROM e WHERE c = ';' AND depth = 0
  UNION ALL SELECT doc_id, 'FAIL', 'too many senses' FROM d WHERE len(l) > 3
  UNION ALL SELECT doc_id, 'WARN', 'many commas in one sense' FROM d WHERE len(list_filter(l, lambda x: len(regexp_extract_all(x, '[,·/]')) >= 2)) > 0
  UNION ALL SELECT doc_id, 'ASK', 'brackets left' FROM d WHERE len(list_filter(l, lambda x: regexp_matches(x, '[(（][^)）]*[)）]'))) > 0)
SELECT severity, reason, count(*) AS n, CAST(floor(count(*) * 1000000.0 / (SELECT count(*) FROM f)) AS BIGINT) AS share FROM f GROUP BY severity, reason"""


def audit_redundancy(spark: SparkSession, sf: str) -> DataFrame:
    """Comma-separated parts of every sentence as senses; words of two letters count as transliterations."""
    rows = B.sentences(spark, sf).select("doc_id", "sent", F.filter(F.transform(F.split("text", ",", -1), lambda x: F.trim(x)), lambda x: x != "").alias("lines"),
                                         F.filter(F.split(F.regexp_replace("text", ",", ""), " ", -1), lambda x: F.length(x) == 2).alias("sounds"))
    return A.audit_redundancy(rows, ["doc_id", "sent"], "lines", "sounds")


def _cf(c: str) -> str:
    return f"regexp_replace({c}, '(?:[()（）\\[\\],·/]|{_SP})+', '', 'g')"


REDUNDANT_ORACLE = f"""WITH {B.SENTENCES_SQL}, r AS (SELECT doc_id, sent, list_filter(list_transform(string_split(text, ','), lambda x: trim(x, ' ')), lambda x: x <> '') AS l,
  list_filter(string_split(replace(text, ',', ''), ' '), lambda x: length(x) = 2) AS k FROM sentences),
p AS (SELECT doc_id, sent, i - 1 AS lo, j - 1 AS other, l[i] AS a, l[j] AS b, list_contains(k, l[i]) AS ka, list_contains(k, l[j]) AS kb FROM r, unnest(range(1, len(l) + 1)) AS u(i), unnest(range(1, len(l) + 1)) AS v(j) WHERE i < j),
q AS (SELECT *, {_cf('a')} AS na, {_cf('b')} AS nb, trim(regexp_replace(a, '[(（][^)）]*[)）]', '', 'g'), ' ') AS ba, trim(regexp_replace(b, '[(（][^)）]*[)）]', '', 'g'), ' ') AS bb FROM p),
s AS (SELECT *, list_distinct(string_split(na, '')) AS ca, list_distinct(string_split(nb, '')) AS cb FROM q),
t AS (SELECT doc_id, sent, lo, other, CASE WHEN ka AND NOT kb THEN 'first is a transliteration' WHEN kb AND NOT ka THEN 'second is a transliteration'
  WHEN regexp_matches(a, '[0-9０-９]') <> regexp_matches(b, '[0-9０-９]') AND greatest(length(a), length(b)) <= 6 THEN 'digits beside words'
  WHEN ba <> '' AND ba = bb THEN 'same without brackets' WHEN na = nb THEN 'same'
  WHEN na <> '' AND nb <> '' AND len(list_intersect(ca, cb)) >= 0.8 * (len(ca) + len(cb) - len(list_intersect(ca, cb))) - 1e-9 THEN 'nearly the same letters' END AS reason FROM s)
SELECT doc_id, sent, lo AS "at", other, reason FROM t WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, sent ORDER BY lo, other) = 1"""


def cross_key_conflict(spark: SparkSession, sf: str) -> DataFrame:
    """Part names sold under several brands with several types."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return A.cross_key_conflicts(parts, ["p_name"], "p_brand", "p_type")


CROSS_ORACLE = """SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1 AND count(DISTINCT p_type) > 1)"""


def suppress_exceptions(spark: SparkSession, sf: str) -> DataFrame:
    """Two-branch examples per first letter, without the branches the benchmark lists as exceptions."""
    kana = B.kana_words(spark, sf)
    other = F.reverse("word")
    regular = kana.select(F.left("word", F.lit(1)).alias("ch"), F.col("word").alias("id"), F.when(F.length("word") % 3 == 0, F.col("surface")).otherwise(
        F.concat("annotated", F.lit("・"), B.annotated_of(other))).alias("w"))
    listed = B.benchmark_words(spark, sf)
    exceptions = listed.select(F.left("word", F.lit(1)).alias("ch"), B.annotated_of(F.col("word")).alias("w")).unionByName(
        listed.select(F.right("word", F.lit(1)).alias("ch"), B.annotated_of(F.col("word")).alias("w")))
    return A.suppress_exceptions(regular, exceptions, ["ch"])


SUPPRESS_ORACLE = f"""WITH {B.KANA_SQL}, {B.BENCHMARK_SQL}, x AS (SELECT word FROM benchmark_words),
ban AS (SELECT word, word[1] AS ch FROM x UNION SELECT word, word[-1] FROM x),
k AS (SELECT word, word[1] AS ch, surface, reading, reverse(word) AS o, length(word) % 3 = 0 AND regexp_matches(word, '[^aeiou]') AS raw, length(word) % 3 = 0 AS single FROM kana),
j AS (SELECT k.*, a.word IS NOT NULL AS ha, b.word IS NOT NULL AS hb FROM k LEFT JOIN ban a ON a.word = k.word AND a.ch = k.ch LEFT JOIN ban b ON b.word = k.o AND b.ch = k.ch)
SELECT ch, word AS id, CASE WHEN single THEN surface WHEN ha THEN {B.surface_sql('o')} WHEN hb THEN surface ELSE surface || '・' || {B.surface_sql('o')} END AS surface,
  CASE WHEN raw THEN '' WHEN single THEN reading WHEN ha THEN {B.reading_sql('o')} WHEN hb THEN reading ELSE reading || '・' || {B.reading_sql('o')} END AS reading,
  CASE WHEN single THEN false ELSE ha OR hb END AS changed FROM j WHERE raw OR NOT (ha AND (single OR hb))"""


def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    """First rows per label verdict with the number left out, over labelled documents."""
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return A.report(rows, ["quality", "toxic"], [F.desc("n_chars"), F.asc("doc_id")], 5).select("quality", "toxic", "doc_id", "line", "more")


REPORT_ORACLE = """SELECT quality, toxic, l.doc_id, row_number() OVER w AS line, greatest(count(*) OVER (PARTITION BY quality, toxic) - 5, 0) AS more
FROM labels l JOIN documents d ON d.doc_id = l.doc_id WINDOW w AS (PARTITION BY quality, toxic ORDER BY n_chars DESC, l.doc_id) QUALIFY line <= 5"""


def audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Label verdicts over a reproducible sample of fifty documents."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return A.audit_sample(docs, table(spark, sf, "labels"), "doc_id", ["quality", "toxic"], 50, 7)


SAMPLE_ORACLE = """WITH s AS (SELECT doc_id FROM documents ORDER BY md5(doc_id || '|7'), doc_id LIMIT 50),
v AS (SELECT l.quality, l.toxic FROM s LEFT JOIN labels l USING (doc_id))
SELECT quality, toxic, count(*) AS n, CAST(floor(count(*) * 1000000 / (SELECT count(*) FROM v)) AS BIGINT) AS share FROM v GROUP BY quality, toxic"""


def sort_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Examples of every stem in display order: word length, sense length, reading length, sense."""
    kana = B.kana_words(spark, sf).select(F.left("word", F.lit(2)).alias("stem"), "word", "annotated")
    order = [X.word_length(F.col("annotated")).alias("a"), F.length(X.first_sense(F.col("word"))).alias("b"), X.reading_length(F.col("annotated")).alias("c"), X.first_sense(F.col("word")).alias("d")]
    keyed = kana.select("stem", "word", *order)
    return O.ranged_position(keyed, ["stem"], ["a", "b", "c", "d", "word"], "place").select("stem", "word", "place")


SORT_ORACLE = f"""WITH {B.KANA_SQL} SELECT left(word, 2) AS stem, word, row_number() OVER (PARTITION BY left(word, 2) ORDER BY length(surface), length(word), length(reading), word) AS place FROM kana"""


def top_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Top three words per language and stem; stems placed by their best count."""
    freq = B.words(spark, sf).groupBy("lang", F.left("word", F.lit(2)).alias("stem"), "word").agg(F.count(F.lit(1)).alias("freq"))
    best = O.top_k(freq, ["lang", "stem"], [F.desc("freq"), F.desc("word")], 3)
    sizes = freq.groupBy("lang", "stem").agg((-F.max("freq")).alias("neg"))
    placed = O.ranged_position(sizes, ["lang"], ["neg", "stem"], "place").select("lang", "stem", "place")
    return best.join(placed, ["lang", "stem"]).select("lang", "stem", "word", "freq", "rank", "place")


TOP_ORACLE = f"""WITH {B.WORDS_SQL}, f AS (SELECT lang, left(word, 2) AS stem, word, count(*) AS freq FROM words GROUP BY ALL),
p AS (SELECT lang, stem, row_number() OVER (PARTITION BY lang ORDER BY max(freq) DESC, stem) AS place FROM f GROUP BY lang, stem)
SELECT f.lang, f.stem, word, freq, row_number() OVER (PARTITION BY f.lang, f.stem ORDER BY freq DESC, word DESC) AS rank, place FROM f JOIN p ON p.lang = f.lang AND p.stem = f.stem QUALIFY rank <= 3"""

QUERIES = {
    "stats_records": stats_records, "stats_words": stats_words, "stats_summary": stats_summary, "ordered_merge": ordered_merge, "entry_keys": entry_keys,
    "display_grid": display_grid, "inserted_rows": inserted_rows, "sequence_gaps": sequence_gaps, "set_guards": set_guards, "pair_compare": pair_compare,
    "audit_texts": audit_texts, "audit_redundancy": audit_redundancy, "cross_key_conflict": cross_key_conflict, "suppress_exceptions": suppress_exceptions,
    "audit_report": audit_report, "audit_sample": audit_sample, "sort_examples": sort_examples, "top_examples": top_examples,
}
ORACLES = {
    "stats_records": STATS_ORACLE, "stats_words": STATS_WORDS_ORACLE, "stats_summary": SUMMARY_ORACLE, "ordered_merge": MERGE_ORACLE, "entry_keys": KEYS_ORACLE,
    "display_grid": GRID_ORACLE, "inserted_rows": INSERT_ORACLE, "sequence_gaps": SEQ_ORACLE, "set_guards": GUARDS_ORACLE, "pair_compare": PAIR_ORACLE,
    "audit_texts": AUDIT_ORACLE, "audit_redundancy": REDUNDANT_ORACLE, "cross_key_conflict": CROSS_ORACLE, "suppress_exceptions": SUPPRESS_ORACLE,
    "audit_report": REPORT_ORACLE, "audit_sample": SAMPLE_ORACLE, "sort_examples": SORT_ORACLE, "top_examples": TOP_ORACLE,
}
