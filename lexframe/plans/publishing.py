"""Search over parts, customers and documents; customer records published and planned against a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import guards as G, publish as P, search as S
from lexframe.plans import base as B
from lexframe.session import table


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("key"), F.col("p_size").alias("w"), F.array(
        S.term(F.col("p_name"), "key", F.col("p_type")), S.term(F.col("p_brand"), "level", F.lit("brand")), S.term(F.col("p_type"), "head", F.lit("type"))).alias("t"))
    people = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("key"), F.col("c_nationkey").alias("w"), F.array(
        S.term(F.col("c_name"), "key", F.lit("name")), S.term(F.col("c_mktsegment"), "meaning", F.lit("segment"))).alias("t"))
    docs = B.sentences(spark, sf).select(F.concat(F.lit("d"), "doc_id", F.lit("-"), "sent").alias("key"), F.col("sent").alias("w"), F.array(
        S.term(F.col("text"), "example", F.col("lang"))).alias("t"))
    rows = part.unionByName(people.withColumn("w", F.col("w").cast("int"))).unionByName(docs)
    return S.gather_terms(rows, F.col("t"), F.col("w"))


def search_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the benchmark passages and every part name against all terms."""
    asked = B.benchmark_words(spark, sf).select(F.concat(F.lit("b"), "word").alias("qid"), F.col("word").alias("query"))
    names = table(spark, sf, "part").select(F.lower("p_name").alias("query")).distinct().select(F.concat(F.lit("n"), "query").alias("qid"), "query")
    short = spark.createDataFrame([("s1", "x"), ("s2", " 7 "), ("s3", "ße"), ("s4", "  "), ("s5", "ECONOMY"), ("s6", "SSE")], "qid string, query string")
    return S.search(_terms(spark, sf), asked.unionByName(names).unionByName(short), S.GRAMMAR_RANKS)


SEARCH_ORACLE = f"""WITH {B.SENTENCES_SQL},
terms AS (SELECT 'p' || p_partkey AS key, 0 AS ord, p_name AS text, 'key' AS kind, p_type AS context, p_size AS weight FROM part
  UNION ALL SELECT 'p' || p_partkey, 1, p_brand, 'level', 'brand', p_size FROM part UNION ALL SELECT 'p' || p_partkey, 2, p_type, 'head', 'type', p_size FROM part
  UNION ALL SELECT 'c' || c_custkey, 0, c_name, 'key', 'name', c_nationkey FROM customer UNION ALL SELECT 'c' || c_custkey, 1, c_mktsegment, 'meaning', 'segment', c_nationkey FROM customer
  UNION ALL SELECT 'd' || doc_id || '-' || sent, 0, text, 'example', lang, sent FROM sentences),
q AS (SELECT DISTINCT 'b' || lower(w) AS qid, lower(w) AS query FROM (SELECT unnest(regexp_extract_all(text, '{B.WORD}')) AS w FROM benchmark)
  UNION ALL SELECT DISTINCT 'n' || lower(p_name), lower(p_name) FROM part UNION ALL VALUES ('s1', 'x'), ('s2', '7'), ('s3', 'ße'), ('s5', 'ECONOMY'), ('s6', 'SSE')),
fq AS MATERIALIZED (SELECT DISTINCT {B.fold_sql('query')} AS q FROM q),
ft AS MATERIALIZED (SELECT DISTINCT text, {B.fold_sql('text')} AS t FROM terms),
h AS MATERIALIZED (SELECT q, text, t = q AS same FROM fq JOIN ft ON contains(t, q)),
m AS (SELECT q.qid, q.query, t.*, CASE WHEN same THEN CASE kind WHEN 'key' THEN 0 WHEN 'head' THEN 0 WHEN 'meaning' THEN 2 WHEN 'level' THEN 3 ELSE 5 END ELSE 10 END AS r
  FROM q JOIN h ON h.q = {B.fold_sql('q.query')} JOIN terms t ON t.text = h.text),
b AS (SELECT *, row_number() OVER (PARTITION BY qid, key ORDER BY r, ord) AS n FROM m),
p AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY r, weight DESC, key) AS place, count(*) OVER (PARTITION BY qid) AS total FROM b WHERE n = 1)
SELECT qid, query, place, key, kind AS match_kind, text AS matched_text, context AS match_context, r < 10 AS exact, total FROM p WHERE place <= 80"""


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("key"), "c_name", "c_mktsegment", F.floor("c_acctbal").cast("long").alias("bal"), (F.col("c_custkey") % 5).alias("m"))
    fields = {"Name": F.concat("c_name", F.when(F.col("m") == 3, F.lit("逸")).otherwise("")), "Segment": F.col("c_mktsegment"), "Balance": F.col("bal"), "Empty": F.lit("")}
    return P.note_rows(c, "customer", fields, P.sub_target("root", {"read": "1. read", "write": "2. write"}, F.col("c_mktsegment")))


def _existing(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    shifted = c.where(k % 7 != 0).select(
        k.alias("note_id"), F.concat(F.lit("customer:"), F.when(k % 11 == 0, -k - 1).otherwise(k).cast("string")).alias("key"),
        F.create_map(F.lit("Name"), F.concat("c_name", F.when(k % 5 == 3, F.lit("&#xFA67;")).otherwise("")), F.lit("Segment"), F.when(k % 3 == 0, F.lit("OLD")).otherwise(F.col("c_mktsegment")),
                     F.lit("Balance"), F.floor("c_acctbal").cast("long").cast("string")).alias("fields"))
    return shifted


def _cards(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("ord"), F.col("c_custkey").alias("note_id"), "c_mktsegment").select(
        (F.col("note_id") * 2 + F.col("ord")).alias("card_id"), "note_id", "ord",
        F.concat(F.lit("root::"), F.when(F.col("ord") == 0, "1. read").otherwise("2. write"), F.lit("::"), F.when(F.col("note_id") % 4 == 0, "elsewhere").otherwise(F.col("c_mktsegment"))).alias("deck"))


def _names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, "read"), (1, "write")], "ord int, name string")


def _moves(spark: SparkSession, sf: str) -> DataFrame:
    return P.plan_moves(P.card_targets(_notes(spark, sf), _existing(spark, sf), _cards(spark, sf), _names(spark), "root"))


def sync_plan(spark: SparkSession, sf: str) -> DataFrame:
    plan = P.plan_sync(_notes(spark, sf), _existing(spark, sf), _moves(spark, sf))
    pair = lambda c: F.coalesce(F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"), F.lit(""))
    return plan.select("key", "note_id", "action", pair("changed").alias("changed"), pair("before").alias("before"))


SYNC_ORACLE = """WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment AS s FROM customer),
e AS (SELECT k, CASE WHEN k % 11 = 0 THEN -k - 1 ELSE k END AS ek FROM c WHERE k % 7 <> 0)
SELECT 'customer:' || c.k AS key, e.k AS note_id, CASE WHEN e.k IS NULL THEN 'add' WHEN c.k % 3 = 0 THEN 'update' WHEN c.k % 4 = 0 THEN 'moved' ELSE 'unchanged' END AS action,
  CASE WHEN e.k IS NOT NULL AND c.k % 3 = 0 THEN 'Segment=' || s ELSE '' END AS changed, CASE WHEN e.k IS NOT NULL AND c.k % 3 = 0 THEN 'Segment=OLD' ELSE '' END AS before
FROM c LEFT JOIN e ON e.ek = c.k
UNION ALL SELECT 'customer:' || ek, e.k, 'stale', '', '' FROM e WHERE ek < 0"""


def sync_moves(spark: SparkSession, sf: str) -> DataFrame:
    """Misplaced cards in batches per target, with the later cards of new notes."""
    moves = _moves(spark, sf)
    batched = P.plan_batches(moves, "target", ["card_id"], F.floor(F.col("card_id") / 4096), 100).select("key", F.col("card_id").alias("card"), "target", "batch")
    notes, plan = _notes(spark, sf), P.plan_sync(_notes(spark, sf), _existing(spark, sf))
    fresh = P.place_new(plan, notes, _names(spark), "root").select("key", F.lit(-1).cast("long").alias("card"), "target", F.lit(-1).cast("long").alias("batch"))
    return batched.unionByName(fresh)


MOVES_ORACLE = """WITH m AS (SELECT 'customer:' || c_custkey AS key, c_custkey * 2 + o AS card, 'root::' || CASE o WHEN 0 THEN '1. read' ELSE '2. write' END || '::' || c_mktsegment AS target
  FROM customer, (VALUES (0), (1)) t(o) WHERE c_custkey % 4 = 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0)
SELECT key, card, target, (row_number() OVER (PARTITION BY target ORDER BY card) - 1) // 100 AS batch FROM m
UNION ALL SELECT 'customer:' || c_custkey, -1, 'root::2. write::' || c_mktsegment, -1 FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0"""


def sync_summary(spark: SparkSession, sf: str) -> DataFrame:
    notes, moves = _notes(spark, sf), _moves(spark, sf)
    plan = P.plan_sync(notes, _existing(spark, sf), moves)
    have = _cards(spark, sf).where("ord = 0").select(F.col("deck").alias("target")).distinct()
    broken = P.broken_notes(notes.unionByName(notes.where("key like '%9'"))).agg(F.count(F.lit(1))).scalar()
    return P.plan_summary(plan, moves, P.plan_targets(plan, notes, moves, have)).withColumn("broken", broken)


SUMMARY_ORACLE = """WITH c AS (SELECT c_custkey AS k, c_mktsegment AS s FROM customer), x AS (SELECT *, k % 7 = 0 OR k % 11 = 0 AS fresh FROM c)
SELECT count(*) FILTER (fresh) AS add, count(*) FILTER (NOT fresh AND k % 3 = 0) AS "update", count(*) FILTER (NOT fresh AND k % 3 <> 0 AND k % 4 <> 0) AS unchanged,
  count(*) FILTER (k % 7 <> 0 AND k % 11 = 0) AS stale, 2 * count(*) FILTER (NOT fresh AND k % 4 = 0) AS move,
  (SELECT count(DISTINCT s) FROM x WHERE fresh OR k % 4 = 0) AS new_targets, count(*) FILTER (k % 10 = 9) AS broken FROM x"""


def packed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events packed and read back, with their properties and fingerprints of equal records."""
    e = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("key"), "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"), "user_id")
    packed = P.pack_records(e, ["event_type", "k"], F.struct(F.col("user_id").alias("owner")))
    back = P.unpack(F.concat(F.left("Data", F.lit(5)), F.lit(" \n"), X.after(F.col("Data"), F.lit(6))), "struct<key:string,record:struct<event_type:string,k:int>,derived:struct<owner:bigint>>")
    opened = packed.select(back.alias("b"), F.regexp_like("Data", F.lit("^[A-Za-z0-9+/=]+$")).alias("ascii"))
    return opened.select(F.col("b.key").alias("key"), F.col("b.record.event_type").alias("event_type"), F.col("b.record.k").alias("k"), F.col("b.derived.owner").alias("owner"), "ascii")


PACKED_ORACLE = "SELECT CAST(event_id AS VARCHAR) AS key, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id AS owner, true AS ascii FROM events"


def example_notes(spark: SparkSession, sf: str) -> DataFrame:
    """One note per document and one per sentence of it, with search text."""
    rows = B.sentences(spark, sf).groupBy("doc_id", "lang").agg(F.sort_array(F.collect_list(F.struct("sent", F.col("text").alias("ja"), F.when(F.length("text") % 2 == 0, F.lit("ok")).otherwise("").alias("ko")))).alias("examples"))
    base = rows.select(F.col("doc_id").cast("string").alias("key"), "lang", "examples")
    fields = {"Lang": F.col("lang"), "Text": P.search_text(F.col("examples"))}
    placement = F.create_map(F.lit(P.ANY_CARD), F.concat(F.lit("docs::"), "lang"))
    notes = P.note_rows(base, "doc", fields, placement).unionByName(P.example_notes(base, "line", fields, placement))
    return notes.select("key", F.col("fields.Lang").alias("lang"), F.md5("fields.Text").alias("text"), F.element_at("placement", F.lit("*")).alias("deck"))


NOTES_ORACLE = f"""WITH {B.SENTENCES_SQL}, l AS (SELECT *, regexp_replace(text, '\\([^)]*\\)', '', 'g') || CASE WHEN length(text) % 2 = 0 THEN '<br>ok' ELSE '' END AS t,
  row_number() OVER (PARTITION BY doc_id ORDER BY sent) AS n FROM sentences)
SELECT 'doc:' || doc_id AS key, lang, md5(string_agg(t, '<br>' ORDER BY sent)) AS text, 'docs::' || lang AS deck FROM l GROUP BY doc_id, lang
UNION ALL SELECT 'line:' || doc_id || ':' || n, lang, md5(t), 'docs::' || lang FROM l"""


def validate_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Contract violations of documents, labels and pages."""
    t = F.col("text")
    docs = table(spark, sf, "documents")
    stripped = F.regexp_replace(t, r"[ \n\t]+$", "")
    one = G.validate(docs, ["doc_id"], [
        ("terminator", ~stripped.rlike("[.!?]$"), F.col("lang")), ("brackets", F.length(F.regexp_replace(t, "[^(]", "")) != F.length(F.regexp_replace(t, "[^)]", "")), F.lit("text")),
        ("start", t.rlike("^[a-z,;]"), F.lit("text[0]")), ("trimmed", F.length(t) != F.length(stripped), F.lit("text")), ("size", F.col("n_chars") != F.length(t), F.lit("n_chars")),
        ("lang", ~F.col("lang").isin("en", "de", "es"), F.col("source"))]).select(F.concat(F.lit("d"), "doc_id").alias("id"), "rule", "path")
    two = G.validate(table(spark, sf, "labels"), ["doc_id"], [("quality", ~F.col("quality").isin(1), F.lit("quality")), ("toxic", F.col("toxic") > 0, F.lit("toxic"))]).select(F.concat(F.lit("l"), "doc_id").alias("id"), "rule", "path")
    three = G.validate(table(spark, sf, "pages"), ["page_id"], [("scheme", ~F.col("url").startswith("https"), F.lit("url")), ("title", ~F.col("html").contains("<title>"), F.lit("html"))]).select(F.concat(F.lit("p"), "page_id").alias("id"), "rule", "path")
    return one.unionByName(two).unionByName(three)


CONTRACT_ORACLE = """WITH d AS (SELECT *, regexp_replace(text, '[ \\n\\t]+$', '') AS s FROM documents)
SELECT 'd' || doc_id AS id, 'terminator' AS rule, lang AS path FROM d WHERE NOT regexp_matches(s, '[.!?]$')
UNION ALL SELECT 'd' || doc_id, 'brackets', 'text' FROM d WHERE length(regexp_replace(text, '[^(]', '', 'g')) <> length(regexp_replace(text, '[^)]', '', 'g'))
UNION ALL SELECT 'd' || doc_id, 'start', 'text[0]' FROM d WHERE regexp_matches(text, '^[a-z,;]')
UNION ALL SELECT 'd' || doc_id, 'trimmed', 'text' FROM d WHERE s <> text
UNION ALL SELECT 'd' || doc_id, 'size', 'n_chars' FROM d WHERE n_chars <> length(text)
UNION ALL SELECT 'd' || doc_id, 'lang', source FROM d WHERE lang NOT IN ('en', 'de', 'es')
UNION ALL SELECT 'l' || doc_id, 'quality', 'quality' FROM labels WHERE quality <> 1 UNION ALL SELECT 'l' || doc_id, 'toxic', 'toxic' FROM labels WHERE toxic > 0
UNION ALL SELECT 'p' || page_id, 'scheme', 'url' FROM pages WHERE NOT starts_with(url, 'https') UNION ALL SELECT 'p' || page_id, 'title', 'html' FROM pages WHERE NOT contains(html, '<title>')"""

QUERIES = {"search_ranked": search_ranked, "sync_plan": sync_plan, "sync_moves": sync_moves, "sync_summary": sync_summary, "packed_records": packed_records,
           "example_notes": example_notes, "validate_contract": validate_contract}
ORACLES = {"search_ranked": SEARCH_ORACLE, "sync_plan": SYNC_ORACLE, "sync_moves": MOVES_ORACLE, "sync_summary": SUMMARY_ORACLE, "packed_records": PACKED_ORACLE,
           "example_notes": NOTES_ORACLE, "validate_contract": CONTRACT_ORACLE}
