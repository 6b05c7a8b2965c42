"""Ledger and curation queries: events as ledger rows and edits, customers as records, turns as requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.operators import curate as C, ledger as L
from lexframe.plans import base as B
from lexframe.session import table

MODELS = ["purchase", "view", "click"]


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("model"), F.when(F.col("value") >= 20, "draft").otherwise("review").alias("purpose"),
        F.concat_ws("-", "user_id", F.get_json_object("props", "$.k").cast("int") % 20).alias("key"),
        F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("ts"))


_LEDGER = """ledger AS (SELECT event_type AS model, CASE WHEN value >= 20 THEN 'draft' ELSE 'review' END AS purpose,
  user_id || '-' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 20) AS key, CAST(event_id AS VARCHAR) AS value, event_id AS ts FROM events)"""


def ledger_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Layered lookup of every (purpose, key); keys with an error event are revoked for older models."""
    ledger = _ledger(spark, sf)
    wanted = ledger.select("purpose", "key").distinct()
    return L.ledger_lookup(wanted, ledger, MODELS, ledger.where("model = 'error'").select("purpose", "key"))


LOOKUP_ORACLE = f"""WITH {_LEDGER}, w AS (SELECT DISTINCT purpose, key FROM ledger),
r AS (SELECT DISTINCT purpose, key FROM ledger WHERE model = 'error'),
m AS (SELECT *, row_number() OVER (PARTITION BY model, purpose, key ORDER BY ts DESC) AS n, CASE model WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS p FROM ledger WHERE model IN ('purchase', 'view', 'click')),
b AS (SELECT m.*, row_number() OVER (PARTITION BY m.purpose, m.key ORDER BY p) AS k FROM m LEFT JOIN r ON r.purpose = m.purpose AND r.key = m.key WHERE n = 1 AND (p = 1 OR r.key IS NULL))
SELECT w.purpose, w.key, b.value, b.model AS from_model FROM w LEFT JOIN b ON b.purpose = w.purpose AND b.key = w.key AND b.k = 1"""


def missing_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Slots without an acceptable value, with the reasons of two sources merged."""
    ledger = _ledger(spark, sf)
    slots = ledger.select("purpose", "key").distinct()
    missing = L.missing_keys(slots, ledger, F.col("value").cast("long") % 2 == 0, ["purpose", "key"])
    def why(model: str) -> DataFrame:
        return ledger.where(F.col("model") == model).groupBy("purpose", "key").agg(F.min("value").alias("why"))
    reasons = L.merge_reasons(why("signup"), why("error"), ["purpose", "key"])
    return missing.join(reasons, ["purpose", "key"], "left")


MISSING_ORACLE = f"""WITH {_LEDGER}, w AS (SELECT DISTINCT purpose, key FROM ledger),
ok AS (SELECT DISTINCT purpose, key FROM ledger WHERE CAST(value AS BIGINT) % 2 = 0),
s AS (SELECT purpose, key, min(value) AS why FROM ledger WHERE model = 'signup' GROUP BY ALL),
e AS (SELECT purpose, key, min(value) AS why FROM ledger WHERE model = 'error' GROUP BY ALL)
SELECT w.purpose, w.key, coalesce(e.why, s.why) AS why FROM w LEFT JOIN s USING (purpose, key) LEFT JOIN e USING (purpose, key)
WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.purpose = w.purpose AND ok.key = w.key)"""


def reuse_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Events reuse what another event of the same user gave: unique in context, overall, or by reading."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    word = F.concat_ws("-", "user_id", k % 10)
    rows = e.select(word.alias("word"), "event_type", k.alias("k"), "event_id")
    items = rows.where("event_type in ('click', 'view')").select("word", F.translate((F.col("k") % 7).cast("string"), "0123456", "あいうえおかき").alias("reading"), F.col("event_type").alias("context"))
    note = F.concat(F.lit("字("), F.translate(F.col("k").cast("string"), "0123456789", "あいうえおかきくけこ"), F.lit(")"))
    previous = rows.where("event_type = 'click' and event_id % 3 = 0").select("word", F.col("event_type").alias("context"), note.alias("annotation"))
    known = rows.where("event_type in ('purchase', 'signup')").select("word", note.alias("annotation"))
    return L.reuse_annotations(items, previous, known)


REUSE_ORACLE = """WITH r AS (SELECT user_id || '-' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 10) AS word, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id FROM events),
n AS (SELECT *, '字(' || translate(CAST(k AS VARCHAR), '0123456789', 'あいうえおかきくけこ') || ')' AS a FROM r),
i AS (SELECT DISTINCT word, translate(CAST(k % 7 AS VARCHAR), '0123456', 'あいうえおかき') AS reading, event_type AS context FROM r WHERE event_type IN ('click', 'view')),
p AS (SELECT word, event_type AS context, a FROM n WHERE event_type = 'click' AND event_id % 3 = 0),
g AS (SELECT DISTINCT word, a FROM n WHERE event_type IN ('purchase', 'signup')),
c1 AS (SELECT i.word, reading, count(DISTINCT a) AS n, any_value(a) AS a FROM i JOIN p ON p.word = i.word AND p.context = i.context GROUP BY ALL),
c2 AS (SELECT word, count(*) AS n, any_value(a) AS a FROM g GROUP BY word),
c3 AS (SELECT x.word, reading, count(DISTINCT a) AS n, any_value(a) AS a FROM (SELECT DISTINCT word, reading FROM i) x JOIN g ON g.word = x.word AND contains(a, reading) GROUP BY ALL)
SELECT d.word, d.reading, CASE WHEN c1.n = 1 THEN c1.a WHEN c2.n = 1 THEN c2.a WHEN c3.n = 1 THEN c3.a END AS annotation,
  CASE WHEN c1.n = 1 THEN 'context' WHEN c2.n = 1 THEN 'overall' WHEN c3.n = 1 THEN 'reading' WHEN c1.n > 1 THEN 'ambiguous' END AS tier
FROM (SELECT DISTINCT word, reading FROM i) d LEFT JOIN c1 ON c1.word = d.word AND c1.reading = d.reading LEFT JOIN c2 ON c2.word = d.word LEFT JOIN c3 ON c3.word = d.word AND c3.reading = d.reading"""


def resolve_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a user in a purpose as attempts; previous outputs kept where an attempt reproduces them."""
    e = _ledger(spark, sf)
    attempts = e.select(F.concat_ws("|", "key", "purpose").alias("key"), F.col("ts").alias("attempt"), (F.col("ts") % 4 == 0).alias("passes"), F.col("value").alias("answer"), F.col("model").alias("reason"))
    resolved = L.resolve_rounds(attempts)
    previous = attempts.groupBy("key").agg(F.max("answer").alias("answer"))
    kept = L.keep_previous(previous, attempts, ["answer"]).select("key", F.col("attempt").alias("kept"))
    return resolved.join(kept, "key", "left")


ROUNDS_ORACLE = f"""WITH {_LEDGER}, a AS (SELECT key || '|' || purpose AS key, ts AS attempt, ts % 4 = 0 AS passes, value AS answer, model AS reason FROM ledger),
b AS (SELECT key, min(attempt) FILTER (passes) AS attempt, arg_max(reason, attempt) FILTER (NOT passes) AS reason FROM a GROUP BY key),
p AS (SELECT key, max(answer) AS answer FROM a GROUP BY key),
k AS (SELECT key, min(attempt) AS kept FROM a JOIN p USING (key, answer) WHERE passes GROUP BY key)
SELECT b.key, a.answer, b.attempt, CASE WHEN b.attempt IS NULL THEN b.reason END AS reason, k.kept
FROM b LEFT JOIN a ON a.key = b.key AND a.attempt = b.attempt LEFT JOIN k ON k.key = b.key"""


def layered_final(spark: SparkSession, sf: str) -> DataFrame:
    """Document values through four layers; reviews of a changed draft do not attach."""
    docs = table(spark, sf, "documents")
    d = F.col("doc_id")
    drafts = docs.select(F.concat(F.lit("doc-"), d.cast("string")).alias("key"), F.split("text", "\n", -1).alias("lines"), "doc_id")
    key, old = F.col("key"), F.array(F.lit("stale"))
    reviews = drafts.where(d % 2 == 0).select(L.content_key(key, F.when(d % 6 == 0, old).otherwise(F.col("lines"))).alias("ckey"), F.array(F.lit("reviewed")).alias("lines"))
    settled = F.when((d % 2 == 0) & (d % 6 != 0), F.array(F.lit("reviewed"))).otherwise(F.col("lines"))
    agreed = drafts.where(d % 3 == 1).select(L.content_key(key, settled).alias("ckey"), F.array(F.lit("agreed"), F.lit("x")).alias("lines"))
    finals = drafts.where(d % 5 == 0).select(L.content_key(key, F.when(d % 3 == 1, F.array(F.lit("agreed"), F.lit("x"))).otherwise(F.col("lines"))).alias("ckey"), F.array(F.lit("final")).alias("lines"))
    out = L.final_value(drafts.select("key", "lines"), reviews, agreed, finals)
    return out.select("key", F.array_join("value", "|").alias("value"), "layer")


LAYERED_ORACLE = """WITH d AS (SELECT doc_id AS d, replace(text, chr(10), '|') AS line FROM documents),
s AS (SELECT *, d % 2 = 0 AND d % 6 <> 0 AS rev, d % 3 = 1 AS agr FROM d),
t AS (SELECT *, d % 5 = 0 AND (agr OR NOT rev) AS fin FROM s)
SELECT 'doc-' || d AS key, CASE WHEN fin THEN 'final' WHEN agr THEN 'agreed|x' WHEN rev THEN 'reviewed' ELSE line END AS value,
  CASE WHEN fin THEN 'final' WHEN agr THEN 'agreement' WHEN rev THEN 'review' ELSE 'draft' END AS layer FROM t"""


def request_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """User turns become numbered request batches; replies of three shapes are parsed; accepted rows are appended."""
    turns = table(spark, sf, "conversations")
    said = F.coalesce("text", F.lit(""))
    asked = turns.where("role = 'user'").select("conv_id", "turn", said.alias("w"))
    numbered = L.number_requests(asked, ["conv_id", "turn"], F.floor(F.col("conv_id") / 64), 40)
    bodies = L.build_requests(numbered, ["w"])
    rows = F.from_json("body", "array<struct<i:int,w:string>>")
    made = F.transform(rows, lambda r: F.struct(r["i"].alias("i"), F.array(F.lower(r["w"])).alias("ko"), F.lit("").alias("why")))
    first = F.length(F.get(rows, F.lit(0))["w"])
    reply = (
        F.when(first % 5 == 4, F.lit("sorry {broken"))
        .when(first % 2 == 1, F.concat(F.lit("```json\n"), F.to_json(made), F.lit("\n```")))
        .otherwise(F.concat(F.lit("Here: "), F.to_json(F.struct(made.alias("results")))))
    )
    replies = bodies.select("batch", reply.alias("response"))
    parsed = L.parse_responses(replies, "batch", "response", "struct<i:int,ko:array<string>,why:string>")
    joined = numbered.join(parsed, ["batch", "i"])
    answers = joined.select(
        F.lit("m").alias("model"), F.lit("gloss").alias("purpose"), F.col("w").alias("key"),
        F.array_join("answer.ko", "\n").alias("value"), F.col("conv_id").alias("ts"))
    ledger = turns.where("role = 'assistant'").select(
        F.lit("m").alias("model"), F.lit("gloss").alias("purpose"), said.alias("key"))
    return L.upsert_ledger(ledger, answers, F.length("value") > 2).select("key", "value", "ts")


CYCLE_ORACLE = """WITH u AS (SELECT conv_id, turn, coalesce(text, '') AS w, row_number() OVER (ORDER BY conv_id, turn) - 1 AS n FROM conversations WHERE role = 'user'),
b AS (SELECT *, n // 40 AS batch FROM u), f AS (SELECT batch, length(w) AS l FROM b WHERE n % 40 = 0)
SELECT w AS key, lower(w) AS value, max(conv_id) AS ts FROM b JOIN f USING (batch)
WHERE f.l % 5 <> 4 AND length(w) > 2 AND w NOT IN (SELECT coalesce(text, '') FROM conversations WHERE role = 'assistant') GROUP BY w"""


def group_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Turns batched in whole conversations, twenty at a time."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    return L.group_batches(turns, ["conv_id"], ["turn"], F.floor(F.col("conv_id") / 64), 20)


GROUPS_ORACLE = "SELECT conv_id, turn, (dense_rank() OVER (ORDER BY conv_id) - 1) // 20 AS batch FROM conversations"


def template_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Templates of every word, filled for some, through the tiered gate."""
    n = F.length("word")
    kana = B.kana_words(spark, sf).withColumn("template", L.build_templates(F.col("surface")))
    runs = F.regexp_extract_all("word", F.lit("[^aeiou]+"), F.lit(0))
    filled = kana.withColumn("filled", L.fill_template(F.col("template"), F.transform(runs, B.reading_of)))
    items = filled.select(F.col("surface").alias("word"), F.when(n % 3 == 0, F.lit("ぬぬ")).otherwise(F.col("reading")).alias("reading"), (n % 2 == 0).alias("exception"))
    def attempt(tier: int, keep, value) -> DataFrame:
        return filled.where(keep).select(F.col("surface").alias("word"), F.when(n % 3 == 0, F.lit("ぬぬ")).otherwise(F.col("reading")).alias("reading"), F.lit(tier).alias("tier"), value.alias("annotated"))
    attempts = attempt(0, n % 4 == 0, F.col("annotated")).unionByName(attempt(1, n % 4 == 1, F.col("surface"))).unionByName(attempt(2, n % 4 <= 2, F.col("filled")))
    return L.furigana_gate(items, attempts)


TEMPLATE_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n, length(word) % 3 = 0 AS odd FROM kana)
SELECT surface AS word, CASE WHEN odd THEN 'ぬぬ' ELSE reading END AS reading, CASE WHEN n % 4 <= 2 THEN annotated END AS annotated,
  CASE WHEN n % 4 = 0 THEN 0 WHEN n % 4 = 1 AND regexp_full_match(word, '[aeiou]+') THEN 1 WHEN n % 4 <= 2 THEN 2 END AS tier,
  CASE WHEN n % 4 = 3 THEN 'empty' WHEN NOT odd THEN 'ok' WHEN n % 2 = 0 THEN 'mismatch' ELSE 'warning' END AS state FROM k"""


def _edits(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("ord"), F.when(F.col("event_type") == "signup", " ").otherwise(F.col("event_type")).alias("reason"),
        F.floor(k / 5 % 5).cast("int").cast("string").alias("expected_etag"), (k % 5).cast("string").alias("new_etag"), (F.col("event_type") != "error").alias("valid"))


def apply_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as edits of per-user records; every second user has no record at all."""
    edits = _edits(spark, sf)
    base = edits.where("key % 2 = 0").select("key", F.lit("0").alias("etag")).distinct()
    return C.judge_edits(edits, base).select("key", "ord", F.coalesce("current", F.lit("")).alias("current"), "status")


EDITS_ORACLE = """WITH RECURSIVE e AS (SELECT user_id AS key, event_id AS ord, event_type AS t, (CAST(json_extract_string(props, '$.k') AS INTEGER) // 5) % 5 AS want, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS give,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
s AS (SELECT key, 0 AS n, 0::BIGINT AS cur, 0::BIGINT AS ord, '' AS status, 0::BIGINT AS met FROM (SELECT DISTINCT key FROM e)
  UNION ALL
  SELECT e.key, e.n, CASE WHEN e.t NOT IN ('signup', 'error') AND e.key % 2 = 0 AND e.want = s.cur THEN e.give ELSE s.cur END, e.ord,
    CASE WHEN e.t = 'signup' THEN 'reason' WHEN e.key % 2 = 1 THEN 'unknown' WHEN e.want <> s.cur THEN 'conflict' WHEN e.t = 'error' THEN 'invalid' WHEN e.give = s.cur THEN 'unchanged' ELSE 'saved' END, s.cur
  FROM s JOIN e ON e.key = s.key AND e.n = s.n + 1)
SELECT key, ord, CASE WHEN key % 2 = 1 THEN '' ELSE CAST(met AS VARCHAR) END AS current, status FROM s WHERE n > 0"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.struct(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.array(F.struct(F.col("c_nationkey").alias("nation"), F.floor("c_acctbal").cast("long").alias("bal"))).alias("homes"),
        F.create_map(F.lit("seg"), F.col("c_mktsegment")).alias("extra")).alias("record"))


def record_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of every customer: changed segment, added home, emptied list, dropped map value; in order."""
    before = _records(spark, sf)
    k, r = F.col("key"), F.col("record")
    after = before.select("key", F.struct(
        r["name"].alias("name"), F.when(k % 3 == 0, F.lit("NEW")).otherwise(r["segment"]).alias("segment"),
        F.when(k % 5 == 0, F.concat(r["homes"], r["homes"])).when(k % 11 == 1, F.slice(r["homes"], 1, 0)).otherwise(r["homes"]).alias("homes"),
        F.when(k % 7 == 0, F.create_map(F.lit("other"), r["segment"])).otherwise(r["extra"]).alias("extra")).alias("record"))
    return C.diff_records(before, after).withColumn("added", F.col("order") >= C.ADDED).withColumn("order", F.col("order") % C.ADDED)


DIFF_ORACLE = """WITH c AS (SELECT c_custkey AS k, c_mktsegment AS s, c_nationkey AS n, CAST(floor(c_acctbal) AS BIGINT) AS b FROM customer)
SELECT k AS key, 'segment' AS path, s AS before, 'NEW' AS after, 1 AS "order", false AS added FROM c WHERE k % 3 = 0
UNION ALL SELECT k, 'homes[1].nation', NULL, CAST(n AS VARCHAR), 4, true FROM c WHERE k % 5 = 0
UNION ALL SELECT k, 'homes[1].bal', NULL, CAST(b AS VARCHAR), 5, true FROM c WHERE k % 5 = 0
UNION ALL SELECT k, 'homes[0].nation', CAST(n AS VARCHAR), NULL, 2, false FROM c WHERE k % 5 <> 0 AND k % 11 = 1
UNION ALL SELECT k, 'homes[0].bal', CAST(b AS VARCHAR), NULL, 3, false FROM c WHERE k % 5 <> 0 AND k % 11 = 1
UNION ALL SELECT k, 'homes', NULL, '[]', 2, true FROM c WHERE k % 5 <> 0 AND k % 11 = 1
UNION ALL SELECT k, 'extra.seg', s, NULL, 4, false FROM c WHERE k % 7 = 0
UNION ALL SELECT k, 'extra.other', NULL, s, CASE WHEN k % 5 = 0 THEN 6 WHEN k % 11 = 1 THEN 3 ELSE 4 END, true FROM c WHERE k % 7 = 0"""


def overlay_materialize(spark: SparkSession, sf: str) -> DataFrame:
    """Customers under an overlay of their users' purchases; drifted baselines are reported."""
    base = _records(spark, sf)
    r = F.col("record")
    bought = table(spark, sf, "events").where("event_type = 'purchase'").groupBy(F.col("user_id").alias("key")).agg(F.max("event_id").alias("ev"))
    joined = base.join(bought, "key")
    baseline = F.when(F.col("ev") % 3 == 0, r.withField("name", F.lit("old"))).otherwise(r)
    human = F.when(F.col("ev") % 2 == 0, baseline).otherwise(r.withField("segment", F.lit("EDITED")))
    overlay = joined.select("key", human.alias("human"), baseline.alias("baseline"), C.etag(baseline).alias("baseline_etag"))
    drifted = C.overlay_conflicts(base, overlay).select("key", F.lit(True).alias("drifted"))
    out = C.apply_overlay(base, overlay).join(drifted, "key", "left")
    return out.select("key", F.col("record.name").alias("name"), F.col("record.segment").alias("segment"), "edited", F.coalesce("drifted", F.lit(False)).alias("drifted"))


OVERLAY_ORACLE = """WITH p AS (SELECT user_id AS key, max(event_id) AS ev FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT c_custkey AS key, CASE WHEN ev % 2 = 0 AND ev % 3 = 0 THEN 'old' ELSE c_name END AS name, CASE WHEN ev % 2 = 1 THEN 'EDITED' ELSE c_mktsegment END AS segment,
  coalesce(ev % 2 = 1, false) AS edited, coalesce(ev % 3 = 0, false) AS drifted FROM customer LEFT JOIN p ON p.key = c_custkey"""


def bulk_update(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's lines replaced by marked ones; one bad line refuses the document."""
    rows = B.lines(spark, sf).select("doc_id", F.col("line").alias("pos"), F.col("text").alias("value"))
    clean = F.regexp_replace("value", r"\*", "")
    n = F.length("value")
    marked = F.when((n % 97 == 5) & (F.col("doc_id") % 3 == 0), F.concat(F.lit("*"), clean)).otherwise(F.concat(F.lit("*a*"), clean))
    lines = rows.select("doc_id", "pos", marked.alias("line"))
    good, bad = C.bulk_update(rows, lines, ["doc_id"], "marks")
    done = good.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("size")).withColumn("failures", F.lit(0).cast("long"))
    failed = bad.groupBy("doc_id").agg(F.count(F.lit(1)).alias("failures")).select("doc_id", F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("size"), "failures")
    return done.unionByName(failed)


_TRIM = r"[\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}\x{85}]+"
BULK_ORACLE = f"""WITH {B.LINES_SQL}, m AS (SELECT doc_id, line, length(text) % 97 = 5 AND doc_id % 3 = 0 AS bad,
  length(regexp_replace(CASE WHEN length(text) % 97 = 5 AND doc_id % 3 = 0 THEN '*' ELSE '*a*' END || replace(text, '*', ''), '^{_TRIM}|{_TRIM}$', '', 'g')) AS n FROM lines)
SELECT doc_id, CASE WHEN bool_or(bad) THEN 0 ELSE count(*) END AS lines, CASE WHEN bool_or(bad) THEN 0 ELSE CAST(sum(n) AS BIGINT) END AS size, count(*) FILTER (bad) AS failures FROM m GROUP BY doc_id"""


def rename_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer: rename the urgent priority to the low one unless it exists; the finished ones follow."""
    o = table(spark, sf, "orders")
    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("key")).agg(F.min("o_orderkey").alias("ord"), F.count(F.lit(1)).alias("value"))
    entries, dependent = grouped(o), grouped(o.where("o_orderstatus = 'F'"))
    renames = o.select(F.col("o_custkey").alias("id"), F.lit("1-URGENT").alias("old"), F.lit("5-LOW").alias("new")).distinct()
    out, deps, refused = C.rename_key(entries, renames, dependent)
    r = refused.select("id", F.lit("refused").alias("part"), F.col("old").alias("key"), F.lit(0).cast("long").alias("ord"))
    return out.select("id", F.lit("entry").alias("part"), "key", "ord").unionByName(deps.select("id", F.lit("dependent").alias("part"), "key", "ord")).unionByName(r)


RENAME_ORACLE = """WITH e AS (SELECT o_custkey AS id, o_orderpriority AS key, min(o_orderkey) AS ord FROM orders GROUP BY ALL),
d AS (SELECT o_custkey AS id, o_orderpriority AS key, min(o_orderkey) AS ord FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
bad AS (SELECT id FROM e WHERE key = '5-LOW' UNION SELECT a.id FROM d a JOIN d b ON a.id = b.id AND a.key = '1-URGENT' AND b.key = '5-LOW')
SELECT id, 'entry' AS part, CASE WHEN key = '1-URGENT' AND id NOT IN (SELECT id FROM bad) THEN '5-LOW' ELSE key END AS key, ord FROM e
UNION ALL SELECT id, 'dependent', CASE WHEN key = '1-URGENT' AND id NOT IN (SELECT id FROM bad) THEN '5-LOW' ELSE key END, ord FROM d
UNION ALL SELECT id, 'refused', '1-URGENT', 0 FROM bad"""


def edit_history(spark: SparkSession, sf: str) -> DataFrame:
    """The sixty newest saved edits."""
    edits = _edits(spark, sf).withColumn("at", F.col("ord"))
    base = edits.select("key", F.lit("0").alias("etag")).distinct()
    return C.history(C.judge_edits(edits, base)).select("key", "ord", "reason", "new_etag")


HISTORY_ORACLE = EDITS_ORACLE.replace("AND e.key % 2 = 0 ", "").replace("WHEN e.key % 2 = 1 THEN 'unknown' ", "").rsplit("SELECT", 1)[0] + """SELECT s.key, s.ord, e.t AS reason, CAST(e.give AS VARCHAR) AS new_etag
FROM s JOIN e ON e.key = s.key AND e.n = s.n WHERE s.status = 'saved' ORDER BY s.ord DESC, s.key LIMIT 60"""

def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers as they were edited and as they are: some renamed, some gone, some new."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    record = lambda name: F.struct(name.alias("name"), F.col("c_mktsegment").alias("segment"), F.when(k % 2 == 0, F.lit("gen")).alias("src"))
    was = c.where(k % 97 != 5).select(k.alias("key"), record(F.col("c_name")).alias("record"))
    now = c.where(k % 101 != 9).select(k.alias("key"), record(F.when(k % 89 == 3, F.lit("renamed")).otherwise(F.col("c_name"))).alias("record"))
    return was, now


def _submitted(spark: SparkSession, sf: str) -> DataFrame:
    """Events as submitted records: one of three names, in the customer's segment or another, each expecting one of four versions."""
    e = table(spark, sf, "events").join(table(spark, sf, "customer"), F.col("user_id") % 1000 + 1 == F.col("c_custkey"))
    k, even = F.get_json_object("props", "$.k").cast("int"), F.col("c_custkey") % 2 == 0
    def version(v: Column) -> Column:
        # what the saved record will be: the generated flag survives where the segment stays
        return C.etag(F.struct(
            F.when(v == 3, F.col("c_name")).otherwise(F.concat(F.lit("v"), v.cast("string"))).alias("name"), F.when(v == 1, F.lit("OTHER")).otherwise(F.col("c_mktsegment")).alias("segment"),
            F.when(even & (v != 1), F.lit("gen")).alias("src")))
    v = k % 3
    return e.select(
        F.col("c_custkey").alias("key"), F.col("event_id").alias("ord"), F.col("event_id").alias("at"), F.when(F.col("event_type") == "signup", "").otherwise(F.concat(F.lit(" "), "event_type")).alias("reason"),
        version(F.floor(k / 5) % 4).alias("expected_etag"), (F.col("event_type") != "error").alias("valid"),
        F.struct(F.concat(F.lit("v"), v.cast("string")).alias("name"), F.when(v == 1, F.lit("OTHER")).otherwise(F.col("c_mktsegment")).alias("segment"), F.lit("any").alias("src")).alias("record"))


def edit_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """The overlay that events leave on customers: last record, revision, reasons, provenance; edits of moved records refused."""
    was, now = _versions(spark, sf)
    overlay, log = C.apply_edits(now, _submitted(spark, sf), ("src", "segment", "gen"), C.moved_keys(was, now))
    reasons = C.edit_reasons(log).groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("reason")), ",").alias("reasons"))
    states = log.groupBy("key").agg(F.count(F.lit(1)).alias("edits"), F.count_if(F.col("status") == "moved").alias("moved"), F.count_if(F.col("status") == "conflict").alias("conflicts"))
    out = states.join(overlay, "key", "left").join(reasons, "key", "left")
    return out.select("key", "edits", "moved", "conflicts", "revision", "updated_at", F.col("human.name").alias("name"), F.col("human.segment").alias("segment"), F.col("human.src").alias("src"), "reasons")


OVERLAY_EDITS_ORACLE = """WITH RECURSIVE c AS (SELECT c_custkey AS key, c_mktsegment AS segment, c_custkey % 2 = 0 AS even,
    c_custkey % 101 <> 9 AND c_custkey % 97 <> 5 AND c_custkey % 89 <> 3 AS steady, c_custkey % 101 = 9 AS gone, c_custkey % 97 = 5 AS fresh, c_custkey % 89 = 3 AS renamed FROM customer),
e AS (SELECT c.*, event_id AS ord, event_type AS t, (CAST(json_extract_string(props, '$.k') AS INTEGER) // 5) % 4 AS want, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS give,
  row_number() OVER (PARTITION BY key ORDER BY event_id) AS n FROM events JOIN c ON user_id % 1000 + 1 = key),
s AS (SELECT key, 0 AS n, 3 AS cur, 0::BIGINT AS ord, '' AS status FROM (SELECT DISTINCT key FROM e WHERE steady)
  UNION ALL
  SELECT e.key, e.n, CASE WHEN e.t NOT IN ('signup', 'error') AND e.want = s.cur THEN e.give ELSE s.cur END, e.ord,
    CASE WHEN e.t = 'signup' THEN 'reason' WHEN e.want <> s.cur THEN 'conflict' WHEN e.t = 'error' THEN 'invalid' WHEN e.give = s.cur THEN 'unchanged' ELSE 'saved' END
  FROM s JOIN e ON e.key = s.key AND e.n = s.n + 1),
j AS (SELECT e.key, e.segment, e.even, e.ord, e.give, e.t, coalesce(s.status, CASE WHEN e.gone AND e.fresh THEN 'unknown' ELSE 'moved' END) AS status FROM e LEFT JOIN s ON s.key = e.key AND s.n = e.n),
l AS (SELECT key, segment, even, count(*) AS edits, count(*) FILTER (status = 'moved') AS moved, count(*) FILTER (status = 'conflict') AS conflicts,
  count(*) FILTER (status = 'saved') AS revision, max(ord) FILTER (status = 'saved') AS updated_at, arg_max(give, ord) FILTER (status = 'saved') AS last,
  string_agg(DISTINCT t, ',' ORDER BY t) FILTER (status = 'saved') AS reasons FROM j GROUP BY ALL)
SELECT key, edits, moved, conflicts, nullif(revision, 0) AS revision, updated_at, 'v' || last AS name, CASE WHEN last = 1 THEN 'OTHER' WHEN last IS NOT NULL THEN segment END AS segment,
  CASE WHEN even AND last <> 1 THEN 'gen' END AS src, reasons FROM l"""


def base_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Keys whose record moved between two versions of the customers, found through their fingerprint trees."""
    was, now = _versions(spark, sf)
    return C.moved_keys(was, now)


DRIFT_ORACLE = """WITH c AS (SELECT c_custkey AS key, c_custkey % 97 <> 5 AS was, c_custkey % 101 <> 9 AS now, c_custkey % 89 = 3 AS renamed FROM customer)
SELECT key, CASE WHEN was AND now THEN 'changed' WHEN now THEN 'added' ELSE 'removed' END AS change FROM c WHERE (was AND now AND renamed) OR was <> now"""

QUERIES = {
    "edit_overlay": edit_overlay, "base_drift": base_drift,
    "ledger_lookup": ledger_lookup, "missing_fallback": missing_fallback, "reuse_unique": reuse_unique, "resolve_rounds": resolve_rounds,
    "layered_final": layered_final, "request_cycle": request_cycle, "group_batches": group_batches, "template_gate": template_gate,
    "apply_edits": apply_edits, "record_diff": record_diff, "overlay_materialize": overlay_materialize, "bulk_update": bulk_update,
    "rename_keys": rename_keys, "edit_history": edit_history,
}
ORACLES = {
    "edit_overlay": OVERLAY_EDITS_ORACLE, "base_drift": DRIFT_ORACLE,
    "ledger_lookup": LOOKUP_ORACLE, "missing_fallback": MISSING_ORACLE, "reuse_unique": REUSE_ORACLE, "resolve_rounds": ROUNDS_ORACLE,
    "layered_final": LAYERED_ORACLE, "request_cycle": CYCLE_ORACLE, "group_batches": GROUPS_ORACLE, "template_gate": TEMPLATE_ORACLE,
    "apply_edits": EDITS_ORACLE, "record_diff": DIFF_ORACLE, "overlay_materialize": OVERLAY_ORACLE, "bulk_update": BULK_ORACLE,
    "rename_keys": RENAME_ORACLE, "edit_history": HISTORY_ORACLE,
}
