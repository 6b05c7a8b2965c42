"""License scan by diagonal voting.

All rolling word k-grams of all texts are joined to the k-grams of a fixed table of templates. A hit
votes for the diagonal (place in the text minus place in the template) it lies on; votes are summed
per diagonal, neighbouring diagonals of a long template are merged (words inserted or left out), and
the words of each span are compared with the template before it counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import lower_ascii, named, packed_row, unpacked

#: between words stands everything that is not a digit, a letter a-z or beyond ASCII (after lower-casing)
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2


@dataclass(frozen=True)
class Template:
    """``gap``: merged diagonals differ by this much at most; ``share``: of its words that must match."""

    label: str
    phrase: str
    base: bool = False
    gap: int = 2
    share: float = 0.8


# --- fixed values: phrases and their labels ---
TEMPLATES = (
    Template("cc-by", "cc by", True, 0, 1.0),
    Template("gpl", "general public license", True, 0, 1.0),
    Template("reserved", "all rights reserved", True, 0, 1.0),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("cc-by-nc", "cc by nc", False, 0, 1.0),
    Template("cc-by-sa", "cc by sa", False, 0, 1.0),
)
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def scan_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")


def _gram_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """A row per k-gram of each template: its hash, place ``q``, and what verification needs."""
    rows = []
    for t, template in enumerate(templates):
        tokens = template.phrase.split()
        if not GRAM <= len(tokens) <= 62:
            raise ValueError("a template has 2 to 62 words")
        for q in range(len(tokens) - GRAM + 1):
            rows.append((t, q, tokens[q], tokens[q + 1], tokens, template.label, template.base, template.gap, template.share))
    table = spark.createDataFrame(rows, "t int, q int, a string, b string, tokens array<string>, label string, base boolean, gap int, share double")
    return table.select(_gram_hash(F.col("a"), F.col("b")).alias("gram"), *[c for c in table.columns if c not in "ab"])


def spans(spark: SparkSession, keyed: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Verified spans of ``keyed`` (__id, __hash, __text): label, base, start and end (words), share matched.

    Rows of one (__id, __hash) count once: they hold the same text.
    """
    source = keyed.select("__id", "__hash", scan_words(F.col("__text")).alias("__words"))
    rolling = F.transform(
        F.slice("__words", 2, F.greatest(F.size("__words") - 1, F.lit(0))),
        lambda w, i: _gram_hash(F.get(F.col("__words"), i), w),
    )
    grams = source.select("__id", "__hash", "__words", F.posexplode(rolling).alias("p", "gram"))
    hits = grams.join(F.broadcast(template_grams(spark, templates)), "gram")  # a fixed table
    start = F.col("p") - F.col("q")
    first = F.greatest(start, F.lit(0))
    # the text's words at the template's places on this diagonal; equal for all votes of the diagonal
    seen = F.slice("__words", first + 1, F.size("tokens") + start - first)
    votes = hits.select(
        "__id", "__hash", "t", "label", "base", "gap", "share", "tokens", start.alias("diagonal"),
        _bit(F.col("q")).alias("bit"), "p", F.array_join(seen, " ").alias("seen"), (first - start).alias("skip"),
    )
    diagonals = votes.groupBy("__id", "__hash", "t", "diagonal").agg(
        F.bit_or("bit").alias("bits"), F.min("p").alias("from"), (F.max("p") + GRAM).alias("to"),
        *[F.first(c).alias(c) for c in ("label", "base", "gap", "share", "tokens", "seen", "skip")],
    )
    # words equal at their places, as a bit for each word of the template
    equal = F.aggregate(
        F.transform(F.split("seen", " "), lambda w, i: F.when(w == F.get(F.col("tokens"), i + F.col("skip")), _bit((i + F.col("skip")).cast("int"))).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b),
    )
    row = Window.partitionBy("__id", "__hash", "t")
    ordered = row.orderBy("diagonal")
    merged = (
        diagonals.withColumn("equal", equal)
        .withColumn("opens", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(ordered) > F.col("gap")).cast("int"), F.lit(1)))
        .withColumn("span", F.sum("opens").over(ordered))
        .groupBy("__id", "__hash", "t", "span")
        .agg(
            F.bit_or("equal").alias("equal"), F.min("from").alias("start"), F.max("to").alias("end"),
            *[F.first(c).alias(c) for c in ("label", "base", "share")], F.first(F.size("tokens")).alias("length"),
        )
    )
    share = F.bit_count("equal") / F.col("length")
    return merged.select("__id", "__hash", "label", "base", "start", "end", share.alias("matched"), (share >= F.col("share")).alias("ok")).where("ok").drop("ok")


def scan(spark: SparkSession, docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with the columns of RESULTS; ``spans`` lists the verified spans.

    Null or empty text: no words, no labels (empty strings), null places, score 0. The score is the
    largest matched share of a template's words, 0 without spans. Repeated rows and null keys get
    results of their own text; columns named like a result are replaced, ``text`` is not returned.
    """
    kept = [c for c in docs.columns if c.lower() not in (*RESULTS, text.lower())]
    whole = F.coalesce(named(text), F.lit(""))
    keyed = docs.select(packed_row(kept).alias("__row"), named(key).alias("__id"), F.xxhash64(whole).alias("__hash"), whole.alias("__text"))
    found = spans(spark, keyed, templates)
    base = F.when(F.col("base"), F.col("start"))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    per_text = found.groupBy(F.col("__id").alias("__i"), F.col("__hash").alias("__h")).agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"), joined(F.collect_set("label")).alias("labels"),
        F.max("matched").alias("score"), F.sort_array(F.collect_list(F.struct("start", "end", "label", "matched"))).alias("spans"),
    )
    counted = keyed.select("__row", "__id", "__hash", F.size(scan_words(F.col("__text"))).cast("long").alias("n_words"))
    on = counted["__id"].eqNullSafe(per_text["__i"]) & (counted["__hash"] == per_text["__h"])
    return counted.join(per_text, on, "left").select(
        *unpacked("__row", kept), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )


ORACLE = f"""
WITH tpl AS (
  SELECT *, string_split(phrase, ' ') AS tok
  FROM (VALUES {", ".join(f"({i}, '{t.label}', '{t.phrase}', {str(t.base).lower()}, {t.gap}, {t.share})" for i, t in enumerate(TEMPLATES))}) v(t, label, phrase, base, gap, share)),
tg AS (SELECT t, q, tok[q + 1] AS a, tok[q + 2] AS b FROM tpl, unnest(range(0, len(tok) - 1)) u(q)),
d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM documents),
g AS (SELECT doc_id, unnest(range(0, len(w) - 1)) AS p, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM d WHERE len(w) > 1),
di AS (SELECT doc_id, t, p - q AS diagonal, min(p) AS first FROM g JOIN tg USING (a, b) GROUP BY ALL),
op AS (
  SELECT di.*, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > gap)::INT, 1) AS opens FROM di JOIN tpl USING (t)),
sp AS MATERIALIZED (SELECT *, sum(opens) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS span FROM op),
eq AS (
  SELECT sp.doc_id, sp.t, span, count(DISTINCT j) AS n FROM sp JOIN tpl USING (t) JOIN d USING (doc_id), unnest(range(0, len(tok))) u(j)
  WHERE diagonal + j >= 0 AND w[diagonal + j + 1] = tok[j + 1] GROUP BY ALL),
ok AS (
  SELECT s.doc_id, label, base, start, n / len(tok)::DOUBLE AS matched
  FROM (SELECT doc_id, t, span, min(first) AS start FROM sp GROUP BY ALL) s JOIN eq USING (doc_id, t, span) JOIN tpl USING (t)
  WHERE n / len(tok)::DOUBLE >= share)
SELECT d.doc_id, len(w)::BIGINT AS n_words, count(start) FILTER (base)::BIGINT AS n_base,
       (min(start) FILTER (base))::BIGINT AS first_word, (max(start) FILTER (base))::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ','), '') AS labels,
       coalesce(max(matched), 0)::DOUBLE AS score
FROM d LEFT JOIN ok USING (doc_id) GROUP BY d.doc_id, len(w)"""
