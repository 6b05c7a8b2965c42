"""Source parsers over raw text derived from the tables: lists, entries, properties, payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import curate as C, guards as G
from lexframe.plans import base as B
from lexframe.session import table
from lexframe.sources import payload as P, readers as R

#: order keys that share a block of a payload
BLOCK = 4096


def wordlist_band(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists printed from word counts and benchmark words, parsed back, banded, with families."""
    vocab = B.vocabulary(spark, sf)
    lines = vocab.select(F.when(F.length("word") % 9 == 0, F.concat(F.lit("## "), "word")).otherwise(F.concat_ws(
        ",", B.capitalised(F.col("word")), F.col("freq").cast("string"), F.when(F.col("freq") % 2 == 0, F.lit("#N/A")).otherwise(F.concat(F.col("freq").cast("string"), F.lit(".5"))))).alias("text"))
    second = B.benchmark_words(spark, sf).select(F.concat(F.lit("x"), "word", F.lit(",7,1.5")).alias("text"))
    families = R.parse_families(vocab.select(F.concat_ws(",", "word", F.concat("word", F.lit("s"))).alias("text")))
    union, clash = G.union_lists(R.parse_wordlist(lines, "ngsl"), R.parse_wordlist(second, "tsl"), "word")
    banded = union.withColumn("band", F.when(F.col("list") == "tsl", "TSL").otherwise(X.band(F.col("rank"), [(10, "1-10"), (100, "11-100")], "rest")))
    clashing = clash.select("word").distinct().withColumn("clash", F.lit(True))
    out = R.with_families(banded, families).join(clashing, "word", "left")
    return out.select("word", "list", "rank", "sfi", "band", F.array_join("family", "/").alias("family"), F.coalesce("clash", F.lit(False)).alias("clash"))


WORDLIST_ORACLE = f"""WITH {B.VOCABULARY_SQL}, {B.BENCHMARK_SQL},
a AS MATERIALIZED (SELECT word, 'ngsl' AS list, CAST(freq AS INTEGER) AS rank, CASE WHEN freq % 2 = 1 THEN freq + 0.5 END AS sfi FROM vocabulary WHERE length(word) % 9 <> 0),
b AS MATERIALIZED (SELECT lower('x' || word) AS word, 'tsl' AS list, 7 AS rank, 1.5 AS sfi FROM benchmark_words),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b), both_lists AS MATERIALIZED (SELECT DISTINCT a.word FROM a JOIN b ON a.word = b.word)
SELECT u.word, list, rank, CAST(sfi AS DOUBLE) AS sfi, CASE WHEN list = 'tsl' THEN 'TSL' WHEN rank <= 10 THEN '1-10' WHEN rank <= 100 THEN '11-100' ELSE 'rest' END AS band,
  CASE WHEN v.word IS NOT NULL THEN u.word || '/' || u.word || 's' WHEN list = 'tsl' THEN u.word ELSE {B.capitalised_sql('u.word')} END AS family,
  both_lists.word IS NOT NULL AS clash
FROM u LEFT JOIN vocabulary v ON v.word = u.word LEFT JOIN both_lists ON both_lists.word = u.word"""


def dictionary_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Entries printed from every word, parsed back: surfaces, readings in order, tags."""
    n = F.length("word")
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>\n"))
    kana = B.kana_words(spark, sf)
    text = F.concat(
        F.lit("<entry><k_ele>"), F.when(n % 4 == 0, F.lit("")).otherwise(tag("keb", F.col("surface"))), F.when(n % 4 == 1, tag("keb", F.concat("surface", F.lit("x")))).otherwise(""),
        tag("reb", F.col("reading")), F.when(n % 3 == 0, tag("reb", F.translate("reading", "た", "だ"))).otherwise(""),
        tag("pos", F.when(n % 2 == 0, F.lit("&v1;")).otherwise("&n;")), F.lit("</entry>"))
    return R.parse_entries(kana.select(F.col("freq").alias("o"), text.alias("text")), "o").select("surface", "reading", (F.col("reading_ord._o") * 1000 + F.col("reading_ord.i")).alias("reading_ord"), F.array_join("pos", "|").alias("pos"))


DICT_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n, CASE WHEN length(word) % 2 = 0 THEN '&v1;' ELSE '&n;' END AS pos FROM kana),
r AS (SELECT n, surface, freq, pos, reading, 0 AS i FROM k UNION ALL SELECT n, surface, freq, pos, translate(reading, 'た', 'だ'), 1 FROM k WHERE n % 3 = 0),
s AS (SELECT CASE WHEN n % 4 = 0 THEN reading ELSE surface END AS surface, reading, freq, pos, i FROM r UNION ALL SELECT surface || 'x', reading, freq, pos, i FROM r WHERE n % 4 = 1)
SELECT surface, reading, min(freq * 1000 + i) AS reading_ord, array_to_string(list_sort(list(DISTINCT pos)), '|') AS pos FROM s GROUP BY surface, reading"""


def char_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Property lines printed for the characters of every word, parsed back."""
    kana = B.kana_words(spark, sf)
    lines = kana.select(F.concat(
        F.format_string("U+%04X", F.ascii("surface")), F.lit("\t"), F.when(F.length("word") % 3 == 0, F.lit("kJapaneseOn")).otherwise(F.lit("kHangul")),
        F.lit("\t"), F.translate("word", B.SMALL, B.LARGE), F.lit(":0E "), F.lit("BA")).alias("text")).unionByName(kana.select(F.concat(F.lit("# "), "word").alias("text")))
    return R.parse_char_props(lines, ["kJapaneseOn"]).groupBy("ch", "prop").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


PROPS_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT surface[1] AS ch, translate(word, '{B.SMALL}', '{B.LARGE}') AS v FROM kana WHERE length(word) % 3 = 0), u AS (SELECT * FROM k UNION ALL SELECT ch, 'BA' FROM k)
SELECT ch, 'kJapaneseOn' AS prop, count(*) AS n, min(v) AS low, max(v) AS high FROM u GROUP BY ch"""


def sectioned_list(spark: SparkSession, sf: str) -> DataFrame:
    """Documents printed as sectioned lists, one section per sentence, some with a wrong count."""
    def three(w: Column) -> Column:
        n = F.size(w)
        return F.when(n > 0, F.array(
            F.concat((F.col("sent") % 10).cast("string"), F.lit("학년")), F.concat(F.lit("합계 ("), (n + F.when(n % 7 == 0, 1).otherwise(0)).cast("string"), F.lit("자)")), F.array_join(w, " ")))

    printed = B.sentences(spark, sf).select("doc_id", "sent", F.posexplode(X.let(three, F.regexp_extract_all("text", F.lit(B.WORD), F.lit(0)))).alias("part", "text"))
    items, wrong = R.parse_sections(printed, ["doc_id"], ["sent", "part"], F.floor(F.col("sent") / 1024), r"^(\d)학년$", r"\((\d+)자\)")
    sizes = items.groupBy("doc_id", "section_no").agg(F.first("section").alias("section"), F.count(F.lit(1)).alias("found"), F.min("value").alias("low"))
    return sizes.join(wrong.select("doc_id", "section_no", "declared"), ["doc_id", "section_no"], "left")


SECTION_ORACLE = f"""WITH {B.SENTENCES_SQL}, w AS (SELECT doc_id, sent, regexp_extract_all(text, '{B.WORD}') AS w FROM sentences)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sent) AS section_no, CAST(sent % 10 AS VARCHAR) AS section, len(w) AS found, list_min(w) AS low,
  CASE WHEN len(w) % 7 = 0 THEN len(w) + 1 END AS declared FROM w WHERE len(w) > 0"""


def alternates(spark: SparkSession, sf: str) -> DataFrame:
    """First places of the items of comma lists with alternates, without the benchmark words."""
    pairs = F.regexp_replace("text", r"([A-Za-zÀ-ÿ]+) ([A-Za-zÀ-ÿ]+)", "$1($2),")
    rows = B.sentences(spark, sf).select("doc_id", "sent", pairs.alias("t"))
    listed = B.benchmark_words(spark, sf).select(F.col("word").alias("name"))
    return R.parse_alternates(rows, ["doc_id", "sent"], "t", listed).select("doc_id", "sent", F.col("_i").alias("i"), "name", "alternate")


_SP = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}\x{85}]+"
ALTERNATES_ORACLE = f"""WITH {B.SENTENCES_SQL}, {B.BENCHMARK_SQL},
t AS (SELECT doc_id, sent, string_split(regexp_replace(text, '([A-Za-zÀ-ÿ]+) ([A-Za-zÀ-ÿ]+)', '\\1(\\2),', 'g'), ',') AS l FROM sentences),
i AS (SELECT doc_id, sent, k - 1 AS i, regexp_replace(l[k], '^{_SP}|{_SP}$', '', 'g') AS x FROM t, unnest(range(1, len(l) + 1)) AS u(k)),
p AS (SELECT doc_id, sent, i, regexp_replace(regexp_extract(x, '^([^(]+)(?:\\((.+)\\))?$', 1), '^{_SP}|{_SP}$', '', 'g') AS name, nullif(regexp_extract(x, '^([^(]+)(?:\\((.+)\\))?$', 2), '') AS alternate FROM i WHERE regexp_matches(x, '^([^(]+)(?:\\((.+)\\))?$'))
SELECT doc_id, sent, i, name, alternate FROM p WHERE name NOT IN (SELECT word FROM benchmark_words) QUALIFY row_number() OVER (PARTITION BY name ORDER BY doc_id, sent, i) = 1"""


def multi_gloss(spark: SparkSession, sf: str) -> DataFrame:
    """Gloss cells built from part names and types, keyed by the letters of the brand."""
    part = table(spark, sf, "part")
    cell = F.concat(F.lit("[漢]"), F.replace(F.col("p_name"), F.lit(" "), F.lit("/")), F.lit(" "), "p_type", F.lit(" | "), "p_brand", F.lit(":;|"), "p_name")
    rows = part.select("p_partkey", F.substring("p_type", 1, 3).alias("k"), cell.alias("c"))
    return R.parse_multi_gloss(rows, ["p_partkey"], "k", "c").select("key", F.col("p_partkey").alias("first"), F.col("_i").alias("i"), "gloss")


GLOSS_ORACLE = """WITH p AS (SELECT p_partkey, left(p_type, 3) AS k, string_split(p_name, ' ') AS n, p_type, p_brand, p_name FROM part),
g AS (SELECT p_partkey, k, list_concat(list_transform(n, lambda x: x || ' ' || p_type), [p_brand, p_name]) AS l FROM p),
o AS (SELECT p_partkey, unnest(list_distinct(string_split(k, ''))) AS key, l FROM g),
e AS (SELECT p_partkey, key, i - 1 AS i, l[i] AS gloss FROM o, unnest(range(1, len(l) + 1)) AS u(i)),
f AS (SELECT p_partkey, key, gloss, min(i) AS i FROM e GROUP BY ALL)
SELECT key, p_partkey AS "first", i, gloss FROM f QUALIFY row_number() OVER (PARTITION BY key, gloss ORDER BY p_partkey, i) = 1"""


def payload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer as JSON payloads in blocks of order keys: flattened, nested again, compared; repeated keys refused."""
    # dealt once by order, for both groupings and the join
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey").repartition("l_orderkey").groupBy("l_orderkey", "l_returnflag").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("w"), F.col("l_partkey").cast("string").alias("ko")))).alias("e"))
    maps = items.groupBy("l_orderkey").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("l_returnflag", "e")))).alias("readings"))
    o = table(spark, sf, "orders").join(maps, F.col("o_orderkey") == F.col("l_orderkey"))
    key = F.when((F.col("o_custkey") % 13 == 0), F.lit("same")).otherwise(F.col("o_orderkey").cast("string"))
    entry = F.concat(F.lit('"'), key, F.lit('":'), F.to_json(F.struct(F.col("o_orderpriority").alias("tag"), "readings")))
    # at most BLOCK orders of a customer in a row
    raw = o.groupBy(F.col("o_custkey").alias("payload"), F.floor(F.col("o_orderkey") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", entry.alias("j")))).alias("l")).select(
        "payload", "block", F.concat(F.lit("{"), F.array_join(F.transform("l", lambda x: x["j"]), ","), F.lit("}")).alias("raw"))
    records, refused = P.flatten_blocks(raw, "raw", "struct<tag:string,readings:map<string,array<struct<w:string,ko:string>>>>")
    flat = P.flatten_examples(records, "readings")
    back = P.nest_examples(flat)
    joined = records.join(back, ["payload", "key"])
    same = (F.to_json("bucket") == F.to_json("record.readings")).alias("same")
    shown = joined.select("payload", "key", "ord", F.col("record.tag").alias("tag"), F.size(F.map_keys("bucket")).alias("readings"), same, (F.length(C.etag(F.col("record"))) == 64).alias("tagged"))
    lost = refused.select("payload", F.lit("refused").alias("key"), F.lit(-1).alias("ord"), F.lit("").alias("tag"), F.lit(0).alias("readings"), F.lit(False).alias("same"), F.lit(False).alias("tagged"))
    return shown.unionByName(lost)


PAYLOAD_ORACLE = """WITH o AS (SELECT o_custkey AS payload, o_orderkey, o_orderpriority AS tag, (SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_orderkey = o_orderkey) AS readings FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
n AS (SELECT *, row_number() OVER (PARTITION BY payload ORDER BY o_orderkey) - 1 AS ord, count(*) OVER (PARTITION BY payload) AS c FROM o)
SELECT payload, CASE WHEN payload % 13 = 0 THEN 'same' ELSE CAST(o_orderkey AS VARCHAR) END AS key, ord, tag, readings, true AS same, true AS tagged FROM n WHERE payload % 13 <> 0 OR c = 1
UNION ALL SELECT DISTINCT payload, 'refused', -1, '', 0, false, false FROM n WHERE payload % 13 = 0 AND c > 1"""

QUERIES = {"wordlist_band": wordlist_band, "dictionary_scan": dictionary_scan, "char_properties": char_properties, "sectioned_list": sectioned_list,
           "alternates": alternates, "multi_gloss": multi_gloss, "payload_roundtrip": payload_roundtrip}
ORACLES = {"wordlist_band": WORDLIST_ORACLE, "dictionary_scan": DICT_ORACLE, "char_properties": PROPS_ORACLE, "sectioned_list": SECTION_ORACLE,
           "alternates": ALTERNATES_ORACLE, "multi_gloss": GLOSS_ORACLE, "payload_roundtrip": PAYLOAD_ORACLE}
