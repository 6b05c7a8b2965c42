"""Pattern marking over annotated words of the documents, with the benchmark words as lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.functions import text as X
from lexframe.operators import marking as M
from lexframe.plans import base as B


def _lexicon(spark: SparkSession, sf: str) -> DataFrame:
    words = B.benchmark_words(spark, sf)
    written = words.select(B.surface_of(F.col("word")).alias("word"), F.lit("written").alias("plane"))
    spoken = words.select(B.reading_of(F.col("word")).alias("word"), F.lit("spoken").alias("plane"))
    return written.where("length(word) between 2 and 12").unionByName(spoken.where("length(word) between 3 and 12"))


def _head():
    r, n = F.col("reading"), F.length("word") % 3
    return F.when(F.length(r) < 4, r).when(n == 0, F.substring(r, 2, 2)).when(
        n == 1, F.concat(F.substring(r, 1, 1), F.lit("～"), F.right(r, F.lit(2)))).otherwise(F.concat(F.lit("ない・"), F.right(r, F.lit(3))))


def mark_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Patterns cut from the reading of every word, found again in its two planes."""
    rows = B.kana_words(spark, sf).select("word", F.col("annotated").alias("ja"), _head().alias("head"), F.expr("cast(array() as array<string>)").alias("connect"))
    out = M.mark_patterns(rows, ["word"], _lexicon(spark, sf))
    return out.select("word", "head", "mark_method", F.col("mark_method_spans").alias("spans"), (F.regexp_replace("marked", r"\*", "") == F.col("ja")).alias("whole"))


MARK_ORACLE = f"""WITH {B.KANA_SQL}, {B.BENCHMARK_SQL},
x AS (SELECT word FROM benchmark_words),
spo AS (SELECT {B.reading_sql('word')} AS w FROM x WHERE length({B.reading_sql('word')}) BETWEEN 3 AND 12),
wri AS (SELECT {B.surface_sql('word')} AS w FROM x WHERE length(word) BETWEEN 2 AND 12 UNION SELECT w FROM spo),
k AS (SELECT *, CASE WHEN length(reading) < 4 THEN [reading] WHEN length(word) % 3 = 0 THEN [substr(reading, 2, 2)]
  WHEN length(word) % 3 = 1 THEN [reading[1], right(reading, 2)] ELSE [right(reading, 3)] END AS seg FROM kana),
t AS (SELECT word, seg, 0 AS pl, surface AS s FROM k UNION ALL SELECT word, seg, 1, reading FROM k),
c AS (SELECT word, pl, s, j, len(seg) AS n, p, seg[j] AS g FROM t, unnest(range(1, len(seg) + 1)) AS u(j), unnest(range(1, length(s) + 1)) AS v(p) WHERE substr(s, p + 1, length(seg[j]) - 1) = substr(seg[j], 2)),
h AS MATERIALIZED (SELECT word, pl, s, j, n, p - 1 AS a, p - 1 + length(g) AS b FROM c WHERE CASE WHEN length(g) < 2 THEN s[p] = g
  ELSE contains(g[1] || translate(g[1], 'かきくけこさしすせそたちつてとはひふへほ', 'がぎぐげござじずぜぞだぢづでどばびぶべぼ') || translate(g[1], 'はひふへほ', 'ぱぴぷぺぽ'), s[p]) AND s[p] <> '' END),
g AS (SELECT word, pl, a AS s1, b AS e1, NULL AS s2, NULL AS e2, 0 AS gap, s FROM h WHERE n = 1
  UNION ALL SELECT f.word, f.pl, f.a, f.b, l.a, l.b, l.a - f.b, f.s FROM h f JOIN h l ON f.word = l.word AND f.pl = l.pl AND f.n = 2 AND f.j = 1 AND l.j = 2 AND l.a BETWEEN f.b AND f.b + 14),
first AS (SELECT word, min(pl) AS pl FROM g GROUP BY word), gg AS MATERIALIZED (SELECT DISTINCT g.* FROM g JOIN first USING (word, pl)),
occ AS (SELECT DISTINCT word, pl, s FROM gg), grams AS (SELECT word, pl, a, a + n AS b, substr(s, CAST(a AS INTEGER) + 1, CAST(n AS INTEGER)) AS w FROM occ, unnest(range(0, length(s))) AS u(a), unnest(range(2, 13)) AS v(n) WHERE a + n <= length(s)),
spot AS MATERIALIZED (SELECT word, a, b FROM grams WHERE pl = 0 AND w IN (SELECT w FROM wri) UNION SELECT word, a, b FROM grams WHERE pl = 1 AND w IN (SELECT w FROM spo)),
sc AS (SELECT gg.word, pl, s1, e1, s2, e2, gap, coalesce(max(CASE WHEN a <= s1 AND e1 <= b AND b - a > e1 - s1 THEN 1 ELSE 0 END), 0)
  + coalesce(max(CASE WHEN s2 IS NOT NULL AND a <= s2 AND e2 <= b AND b - a > e2 - s2 THEN 1 ELSE 0 END), 0) AS cut FROM gg LEFT JOIN spot ON spot.word = gg.word GROUP BY gg.word, pl, s1, e1, s2, e2, gap),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY cut, gap, s1, s2) AS rn FROM sc)
SELECT k.word, CASE WHEN length(k.word) % 3 = 2 AND length(k.reading) >= 4 THEN 'ない・' || seg[1] ELSE array_to_string(seg, '～') END AS head,
  CASE b.pl WHEN 0 THEN 'exact/plain' WHEN 1 THEN 'exact/reading' END AS mark_method,
  s1 || '-' || e1 || CASE WHEN s2 IS NULL THEN '' ELSE ',' || s2 || '-' || e2 END AS spans, CASE WHEN b.pl IS NULL THEN NULL ELSE true END AS whole
FROM k LEFT JOIN best b ON b.word = k.word AND b.rn = 1"""


def mark_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    """Words whose head does not occur fall through to supplied pieces and connection forms; tallied."""
    n, r = F.length("word"), F.col("reading")
    rows = B.kana_words(spark, sf).select(
        "word", F.col("annotated").alias("ja"),
        F.when(n % 4 == 0, F.substring(r, 1, 2)).when(n % 4 == 1, F.lit("ゑゑ～ゑ")).otherwise(F.lit("ゑゑ")).alias("head"),
        F.when(n % 4 == 3, F.array(F.concat(F.lit("Ｖます ＋ "), F.substring(r, 1, 3)))).alias("connect"),
        F.when(n % 4 == 1, F.array(F.col("surface"))).when(n % 8 == 2, F.array(F.left("surface", F.lit(1)), F.right("surface", F.lit(1)))).alias("pieces"),
        F.when(n % 8 == 6, F.left("surface", F.lit(2))).alias("legacy"))
    out = M.mark_waterfall(rows, ["word"], _lexicon(spark, sf))
    kind = F.coalesce(F.regexp_extract("mark_method", "^(connect|model)", 1), F.lit("none"))
    kind = F.when(F.col("mark_method").isNotNull() & (kind == ""), "mechanical").otherwise(kind)
    return out.groupBy((F.length("word") % 8).alias("n"), kind.alias("kind"), "revoked").agg(F.count(F.lit(1)).alias("rows"))


WATERFALL_ORACLE = f"""WITH {B.KANA_SQL}, k AS (SELECT *, length(word) AS n FROM kana)
SELECT n % 8 AS n, CASE WHEN n % 4 = 0 THEN 'mechanical' WHEN n % 4 = 1 THEN CASE WHEN length(surface) > 11 THEN 'none' ELSE 'model' END
  WHEN n % 8 = 2 THEN 'model' WHEN n % 8 = 6 THEN 'model' WHEN length(substr(reading, 1, 3)) >= 2 THEN 'connect' ELSE 'none' END AS kind,
  n % 4 = 1 AND length(surface) > 11 AS revoked, count(*) AS rows FROM k GROUP BY ALL"""


def audit_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Marks put at fixed places of every word, audited."""
    n, a = F.length("word") % 4, F.col("annotated")
    marked = F.when(n == 0, F.concat(F.lit("*"), a, F.lit("*"))).when(n == 1, F.concat(F.lit("*"), a)).when(
        n == 2, F.concat(F.lit("*"), F.left(a, F.lit(1)), F.lit("*"), X.after(a, F.lit(2)))).otherwise(F.concat(F.lit("*x*"), a))
    rows = B.kana_words(spark, sf).select("word", a.alias("ja"), marked.alias("marked"), F.lit("model").alias("mark_method"), F.lit("").alias("head"))
    return M.audit_marks(rows, ["word"], _lexicon(spark, sf))


AUDIT_MARKS_ORACLE = f"""WITH {B.KANA_SQL}, {B.BENCHMARK_SQL}, k AS (SELECT *, length(word) % 4 AS n FROM kana),
x AS (SELECT word FROM benchmark_words),
wri AS (SELECT {B.surface_sql('word')} AS w FROM x WHERE length(word) BETWEEN 2 AND 12 UNION SELECT {B.reading_sql('word')} FROM x WHERE length({B.reading_sql('word')}) BETWEEN 3 AND 12)
SELECT word, 'FAIL' AS severity, 'unpaired marks' AS reason FROM k WHERE n = 1
UNION ALL SELECT word, 'FAIL', 'text changes without marks' FROM k WHERE n = 3
UNION ALL SELECT word, 'FAIL', 'mark inside a chunk' FROM k WHERE n = 2 AND regexp_matches(word, '^[^aeiou]')
UNION ALL SELECT word, 'WARN', 'inside a word' FROM k WHERE n = 2 AND EXISTS (SELECT 1 FROM wri WHERE length(w) > 1 AND starts_with(k.surface, w))"""


def pattern_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Forms, connection forms, mark offsets and planes of strings derived from every word."""
    w, a = F.col("word"), F.col("annotated")
    head = F.translate(w, "eo", "～・")
    connect = F.array(F.concat(F.lit("Ｖて ＋ "), F.translate(w, "ae", "／～")))
    marked = F.concat(F.lit("*"), a, F.lit("*えい"))
    def shown(forms):
        return F.array_join(F.sort_array(F.transform(forms, lambda f: F.array_join(f, "+"))), "|")
    return B.kana_words(spark, sf).select(
        "word", shown(M.head_forms(head)).alias("forms"), shown(M.connect_forms(connect, M.head_forms(head))).alias("connected"),
        F.array_join(X.mark_spans(marked), "|").alias("spans"), F.array_join(F.transform(X.mark_offsets(marked), lambda o: o.cast("string")), ",").alias("offsets"),
        X.plane(a, "surface").alias("plain"), X.plane(a, "sound").alias("sound"), F.size(X.chunk_edges(a)).alias("edges"))


FORMS_ORACLE = f"""WITH {B.KANA_SQL},
k AS (SELECT word, surface, reading, annotated, translate(word, 'eo', '～・') AS h, translate(word, 'ae', '／～') AS c FROM kana),
f AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(string_split(h, '・'), lambda p: array_to_string(list_filter(string_split(p, '～'), lambda x: x <> ''), '+')), lambda y: y <> ''))) AS l FROM k),
o AS (SELECT *, list_distinct(list_filter(string_split(c, '／'), lambda x: true)) AS opts FROM f),
m AS (SELECT *, list_slice(list_sort(list_transform(opts, lambda x: 'て' || x)), 1, 8) AS cs FROM o)
SELECT word, array_to_string(l, '|') AS forms,
  array_to_string(list_sort(list_filter(list_distinct(list_transform(list_filter(cs, lambda x: length(replace(x, '～', '')) >= 2), lambda x: array_to_string(list_filter(string_split(x, '～'), lambda y: y <> ''), '+'))), lambda z: NOT list_contains(l, z))), '|') AS connected,
  annotated AS spans, '0,' || length(annotated) AS offsets, surface AS plain, reading AS sound,
  1 + length(regexp_replace(word, '[^aeiou]', '', 'g')) + len(regexp_extract_all(word, '[^aeiou]+')) AS edges FROM m"""

QUERIES = {"mark_patterns": mark_patterns, "mark_waterfall": mark_waterfall, "audit_marks": audit_marks, "pattern_forms": pattern_forms}
ORACLES = {"mark_patterns": MARK_ORACLE, "mark_waterfall": WATERFALL_ORACLE, "audit_marks": AUDIT_MARKS_ORACLE, "pattern_forms": FORMS_ORACLE}
