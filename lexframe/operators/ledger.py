"""Ledger of enrichment requests and responses: ledger(model, purpose, key, value, ts)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import BASE, after, annotation_ok, full_reading, let, reading_matches
from lexframe.operators.order import batch_ids, position


def missing_keys(wanted: DataFrame, ledger: DataFrame, accept: Column, keys: list[str]) -> DataFrame:
    """Wanted keys without an acceptable ledger value."""
    return wanted.join(ledger.where(accept).select(*keys), keys, "left_anti")


def ledger_lookup(keys: DataFrame, ledger: DataFrame, models: list[str], revoked: DataFrame | None = None) -> DataFrame:
    """Latest value of the first model, else of the first older model in order unless revoked."""
    slot = ["purpose", "key"]
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    rows = ledger.where(F.col("model").isin(*models)).groupBy("model", *slot).agg(F.max_by("value", "ts").alias("value"))
    rows = rows.withColumn("_rank", rank)
    if revoked is not None:
        gone = revoked.select(*slot).distinct().withColumn("_gone", F.lit(True))
        rows = rows.join(gone, slot, "left").where((F.col("_rank") == 1) | F.col("_gone").isNull())
    best = rows.groupBy(*slot).agg(F.min(F.struct("_rank", "value")).alias("_b"))
    found = best.select(*slot, F.col("_b.value").alias("value"), F.element_at(F.array(*[F.lit(m) for m in models]), F.col("_b._rank").cast("int")).alias("from_model"))
    return keys.join(found, slot, "left")


def merge_reasons(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Reasons of both sources; the second one wins where both speak."""
    a, b = first.select(*keys, F.col("why").alias("_a")), second.select(*keys, F.col("why").alias("_b"))
    return a.join(b, keys, "full_outer").select(*keys, F.coalesce("_b", "_a").alias("why"))


def _single(value: str, suffix: str) -> list[Column]:
    return [F.min(value).alias(f"lo_{suffix}"), F.max(value).alias(f"hi_{suffix}")]


def reuse_annotations(items: DataFrame, previous: DataFrame, known: DataFrame) -> DataFrame:
    """Reuse an annotation after re-keying: unique in context, else unique overall, else unique for the reading.

    ``items``: word, reading, context.  ``previous``: word, context, annotation.  ``known``: word,
    annotation (checked).  ``tier`` is null where nothing fits and ``ambiguous`` where several do.
    Uniqueness is min = max, so no candidate list is ever collected.
    """
    key = ["word", "reading"]
    local = items.join(previous, ["word", "context"]).groupBy(*key).agg(*_single("annotation", "c"))
    overall = known.groupBy("word").agg(*_single("annotation", "g"))
    fits = reading_matches(full_reading(F.col("annotation")), F.col("reading"))
    matching = items.select(*key).distinct().join(known.distinct(), "word").where(fits).groupBy(*key).agg(*_single("annotation", "m"))
    joined = items.select(*key).distinct().join(local, key, "left").join(overall, "word", "left").join(matching, key, "left")

    def unique(s: str) -> Column:
        return F.col(f"lo_{s}") == F.col(f"hi_{s}")

    several = (F.col("lo_c") != F.col("hi_c"))
    tier = F.when(unique("c"), "context").when(unique("g"), "overall").when(unique("m"), "reading").when(several, "ambiguous")
    value = F.when(unique("c"), F.col("lo_c")).when(unique("g"), F.col("lo_g")).when(unique("m"), F.col("lo_m"))
    return joined.select(*key, value.alias("annotation"), tier.alias("tier"))


def keep_previous(previous: DataFrame, attempts: DataFrame, values: list[str]) -> DataFrame:
    """Previous outputs that some attempt still passing today's checks reproduces, with the first such attempt."""
    kept = attempts.where("passes").join(previous, ["key", *values])
    return kept.groupBy("key", *values).agg(F.min("attempt").alias("attempt"))


def resolve_rounds(attempts: DataFrame) -> DataFrame:
    """(key, answer, attempt, reason): earliest passing attempt, else the reason of the last one."""
    ok = F.col("passes")
    best = attempts.groupBy("key").agg(
        F.min(F.when(ok, F.struct("attempt", "answer"))).alias("_b"), F.max(F.when(~ok, F.struct("attempt", "reason"))).alias("_r"))
    return best.select(
        "key", F.col("_b.answer").alias("answer"), F.col("_b.attempt").alias("attempt"),
        F.when(F.col("_b").isNull(), F.col("_r.reason")).alias("reason"))


def content_key(key: Column, lines: Column) -> Column:
    """Key that detaches when the lines it answers change."""
    return F.concat(key, F.lit("|"), F.left(F.sha1(F.array_join(lines, "\n")), F.lit(10)))


def final_value(drafts: DataFrame, reviews: DataFrame, agreements: DataFrame, finals: DataFrame) -> DataFrame:
    """(key, value, layer): final review over agreement over review over draft.

    ``drafts``: key, lines.  The others: ckey (content key of what they answer), lines (cleaned,
    null when refused).
    """
    def layer(rows: DataFrame, name: str) -> DataFrame:
        return rows.where("lines is not null").select(F.col("ckey").alias("_ck"), F.col("lines").alias(name))

    def apply(df: DataFrame, rows: DataFrame, name: str, current: str, result: str) -> DataFrame:
        keyed = df.withColumn("_ck", content_key(F.col("key"), F.col(current)))
        return keyed.join(layer(rows, name), "_ck", "left").withColumn(result, F.coalesce(name, current)).drop("_ck")

    one = apply(drafts, reviews, "_review", "lines", "_settled")
    two = apply(one, agreements, "_agreed", "_settled", "_pro")
    three = apply(two, finals, "_final", "_pro", "value")
    name = F.when(F.col("_final").isNotNull(), "final").when(F.col("_agreed").isNotNull(), "agreement").when(
        F.col("_review").isNotNull(), "review").otherwise("draft")
    return three.select("key", "value", name.alias("layer"))


def number_requests(missing: DataFrame, order: list[str], bucket: Column, size: int) -> DataFrame:
    """Adds batch and the 1-based number of the row inside its batch."""
    placed = position(missing.withColumn("_all", F.lit(0)), ["_all"], order, bucket, "_n")
    return placed.withColumn("batch", F.floor((F.col("_n") - 1) / size)).withColumn("i", ((F.col("_n") - 1) % size + 1).cast("int")).drop("_n", "_all")


def build_requests(numbered: DataFrame, fields: list[str]) -> DataFrame:
    """(batch, n, body): one JSON list per batch; a batch holds at most its fixed number of rows."""
    row = F.struct("i", *fields)
    return numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.to_json(F.sort_array(F.collect_list(row))).alias("body"))


def group_batches(rows: DataFrame, group: list[str], order: list[str], bucket: Column, size: int) -> DataFrame:
    """Batches counted in whole groups, so that all rows of a group are asked together."""
    return batch_ids(rows, order, bucket, size, group)


def json_block(response: Column) -> Column:
    """Last greedy JSON block of a response, code fences removed; null when there is none."""
    blocks = F.regexp_extract_all(response, F.lit(r"(?s)\{.*\}|\[.*\]"), F.lit(0))
    last = F.when(F.size(blocks) > 0, F.element_at(blocks, -1))
    return F.replace(F.replace(last, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))


def parse_responses(responses: DataFrame, batch: str, text: str, row_schema: str) -> DataFrame:
    """(batch, i, answer): rows of object-or-array answers by number; broken batches yield nothing.

    When a number comes twice the last row counts.
    """
    block = json_block(F.col(text))
    rows = F.when(block.rlike(r"^\s*\["), F.from_json(block, f"array<{row_schema}>")).otherwise(
        F.from_json(block, f"struct<results:array<{row_schema}>>")["results"])
    exploded = responses.select(F.col(batch).alias("batch"), F.posexplode_outer(rows).alias("at", "answer")).where("answer is not null")
    return exploded.where("answer.i is not null").groupBy("batch", F.col("answer.i").alias("i")).agg(F.max_by("answer", "at").alias("answer"))


def upsert_ledger(ledger: DataFrame, answers: DataFrame, accept: Column) -> DataFrame:
    """Rows to append: accepted answers whose slot is still empty, the latest one per slot."""
    slot = ["model", "purpose", "key"]
    fresh = answers.where(accept).groupBy(*slot).agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
    return fresh.join(ledger.select(*slot), slot, "left_anti")


def pick_case_variant(answers: Column, key: Column) -> Column:
    """Value under the key itself, its capitalised or its upper-case form."""
    first = F.concat(F.upper(F.left(key, F.lit(1))), F.lower(after(key, F.lit(2))))
    return F.coalesce(F.try_element_at(answers, key), F.try_element_at(answers, first), F.try_element_at(answers, F.upper(key)))


def build_templates(c: Column) -> Column:
    """Slot ``(READn)`` behind every base run that no printed reading follows."""
    start = F.expr("named_struct('i', 0, 'n', 0, 'out', '')")

    def step(tokens: Column, s: Column, t: Column) -> Column:
        slot = t.rlike(f"^[{BASE}]") & ~F.coalesce(F.get(tokens, s["i"] + 1), F.lit("")).startswith("（")
        n = s["n"] + slot.cast("int")
        return F.struct((s["i"] + 1).alias("i"), n.alias("n"), F.concat(s["out"], t, F.when(slot, F.concat(
            F.lit("(READ"), n.cast("string"), F.lit(")"))).otherwise("")).alias("out"))

    found = F.regexp_extract_all(c, F.lit(f"[{BASE}]+|[^{BASE}]+"), F.lit(0))
    return let(lambda tokens: F.aggregate(tokens, start, lambda s, t: step(tokens, s, t), lambda s: s["out"]), found)


def fill_template(template: Column, readings: Column) -> Column:
    """Template with its n-th slot replaced by the n-th reading."""
    def fill(parts: Column, values: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.when(i < F.size(parts) - 1, F.concat(
            F.lit("("), F.coalesce(F.get(values, i), F.lit("")), F.lit(")"))).otherwise(""))), "")

    return let(fill, F.split(template, r"\(READ[0-9]+\)", -1), readings)


def furigana_gate(items: DataFrame, attempts: DataFrame) -> DataFrame:
    """(word, reading, annotated, tier, state): first valid attempt by tier; contradictions only warn.

    ``items``: word, reading, exception.  ``attempts``: word, reading, tier, annotated.  State is
    ok, warning (reading not contained), mismatch (an exception whose reading is not contained) or
    empty; the stage fails on mismatch and empty rows.
    """
    key = ["word", "reading"]
    # no filter: pushed down, it would work out what makes the annotation once for each use of it
    fits = let(lambda a: F.when(annotation_ok(a) & (F.regexp_replace(a, r"\([^)]*\)", "") == F.col("word")), a), F.col("annotated"))
    judged = attempts.select(*key, "tier", fits.alias("_a"))
    best = judged.groupBy(*key).agg(F.min(F.when(F.col("_a").isNotNull(), F.struct("tier", F.col("_a").alias("annotated")))).alias("_b"))
    inside = reading_matches(full_reading(F.col("_b.annotated")), F.col("reading"))
    state = F.when(F.col("_b").isNull(), "empty").when(inside, "ok").when(F.col("exception"), "mismatch").otherwise("warning")
    return items.join(best, key, "left").select(*key, F.col("_b.annotated").alias("annotated"), F.col("_b.tier").alias("tier"), state.alias("state"))


def enrich(requests: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Apply a user function to every request body; (batch, response, error).

    A failing call answers null and says why in ``error``, so that it is not taken for an empty answer.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            answers, errors = [], []
            for body in part["body"]:
                answer, error = None, None
                try:
                    answer = fn(body)
                except Exception as caught:  # noqa: BLE001 - a broken batch is asked again in the next run
                    error = f"{type(caught).__name__}: {caught}"
                answers.append(answer)
                errors.append(error)
            yield pd.DataFrame({"batch": part["batch"], "response": answers, "error": errors})

    return requests.select("batch", "body").mapInPandas(run, "batch long, response string, error string")
