"""Which characters of a word carry an irregular reading, and what sounds its characters can take.

The reading table is joined on (character, piece of the reading), so a character that occurs in a
third of all words is spread over the pieces; the per-word fold then only sees pieces of its own
reading.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import SMALL_SPLIT, after, kana_fold, let, phonetic_variants

CJK = r"\x{3400}-\x{9FFF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}"
# --- fixed values: words adjudicated by hand (reading, surface, characters) ---
ADJUDICATED = (("うわき", "浮気", "浮"), ("やよい", "弥生", "生"))


def regular_readings(readings: DataFrame) -> DataFrame:
    """(ch, form): readings per character closed under voicing and gemination.  ``readings``: ch, key."""
    stem = kana_fold(F.regexp_replace("key", "ー$", ""))
    return readings.select("ch", F.explode(phonetic_variants(stem)).alias("form")).where("form <> ''").distinct()


def form_lists(forms: DataFrame) -> DataFrame:
    """(ch, forms): the forms of each character as one list.  ``forms``: ch, form."""
    return forms.where("form <> ''").groupBy(F.col("ch").alias("_ch")).agg(F.collect_set("form").alias("_forms"))


def with_pieces(words: DataFrame, cols: list[str], surface: str, reading: str, forms: DataFrame) -> DataFrame:
    """(cols, pieces): every distinct row with the ``ch|piece`` pairs the form table (ch, form) confirms.

    A word is a row per character, which meets the character's list of forms and keeps those that
    stand in the reading; so the work of a word grows with its characters and their forms, not with
    all pieces of its reading.
    """
    chars = F.array_distinct(F.regexp_extract_all(surface, F.lit(f"[{CJK}]"), F.lit(0)))
    rows = words.select(*cols, F.explode_outer(chars).alias("_ch"))
    met = rows.join(form_lists(forms), "_ch", "left")
    found = F.transform(F.filter("_forms", lambda f: F.contains(F.col(reading), f)), lambda f: F.concat(F.col("_ch"), F.lit("|"), f))
    per = met.select(*cols, found.alias("_found")).groupBy(*cols)
    # a list per character of the word
    return per.agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("_found", F.expr("cast(array() as array<string>)"))))).alias("pieces"))


def anchored_runs(surface: Column, reading: Column) -> Column:
    """Array of (run, part): base runs with the reading between their literal neighbours; null when unanchored."""
    found_parts = F.regexp_extract_all(surface, F.lit(f"[{CJK}]+|[^{CJK}]+"), F.lit(0))
    start = F.expr("named_struct('i',0,'cur',0,'ok',true,'prev','','runs',cast(array() as array<struct<run:string,part:string>>))")

    def step(s: Column, t: Column) -> Column:
        base = t.rlike(f"^[{CJK}]")
        first = s["i"] == 0
        found = F.when(first, F.when(reading.startswith(t), F.lit(0)).otherwise(F.lit(-1))).otherwise(
            F.call_function("locate", t, reading, s["cur"] + 1) - 1)
        part = F.substring(reading, s["cur"] + 1, found - s["cur"])
        added = F.when(first, s["runs"]).otherwise(F.array_append(s["runs"], F.struct(s["prev"].alias("run"), part.alias("part"))))
        return F.struct(
            (s["i"] + 1).alias("i"),
            F.when(base | (found < 0), s["cur"]).otherwise(found + F.length(t)).alias("cur"),
            (s["ok"] & (base | (found >= 0))).alias("ok"), t.alias("prev"),
            F.when(base | (found < 0), s["runs"]).otherwise(added).alias("runs"))

    def finish(s: Column) -> Column:
        last = s["prev"]
        ends_base = last.rlike(f"^[{CJK}]")
        tail = F.struct(last.alias("run"), after(reading, s["cur"] + 1).alias("part"))
        runs = F.when(ends_base, F.array_append(s["runs"], tail)).otherwise(s["runs"])
        kept = F.filter(runs, lambda r: (r["run"] != "") & (r["part"] != ""))
        return F.when(s["ok"] & (ends_base | reading.endswith(last)) & (F.size(kept) > 0), kept)

    return F.when(surface != "", F.aggregate(found_parts, start, step, finish))


def best_vectors(run: Column, part: Column, pieces: Column) -> Column:
    """Distinct match vectors ('1' = regular piece) of the best-scoring splits; null when none exists.

    Of all partial splits ending at one place only the best-scoring ones can be part of a best
    split, so the others are dropped at every step.
    """
    n, total = F.length(run), F.length(part)
    start = F.expr("named_struct('i', 0, 'states', array(named_struct('p', 0, 'k', 0, 'v', '')))")

    def step(s: Column, c: Column) -> Column:
        left = n - s["i"] - 1

        def grow(q: Column) -> Column:
            low = F.when(left == 0, F.greatest(total, q["p"] + 1)).otherwise(q["p"] + 1)
            ends = F.when(total - left >= low, F.sequence(low, total - left)).otherwise(F.expr("cast(array() as array<int>)"))
            allowed = F.filter(ends, lambda e: (e == total) | ~F.contains(F.lit(SMALL_SPLIT), F.substring(part, e + 1, F.lit(1))))

            def put(e: Column) -> Column:
                hit = F.array_contains(pieces, F.concat(c, F.lit("|"), F.substring(part, q["p"] + 1, e - q["p"]))).cast("int")
                return F.struct(e.alias("p"), (q["k"] + hit).alias("k"), F.concat(q["v"], hit.cast("string")).alias("v"))

            return F.transform(allowed, put)

        grown = F.flatten(F.transform(s["states"], grow))
        return F.struct((s["i"] + 1).alias("i"), F.aggregate(F.sort_array(grown), _EMPTY_STATES, keep_best).alias("states"))

    def keep_best(kept: Column, q: Column) -> Column:
        # states arrive sorted by place, then score, then vector
        rest = F.filter(kept, lambda o: (o["p"] != q["p"]) | ((o["k"] == q["k"]) & (o["v"] != q["v"])))
        return F.array_append(rest, q)

    _EMPTY_STATES = F.expr("cast(array() as array<struct<p:int,k:int,v:string>>)")
    chars = F.regexp_extract_all(run, F.lit("(?s:.)"), F.lit(0))
    vectors = F.aggregate(chars, start, step, lambda s: F.transform(s["states"], lambda q: q["v"]))
    return let(lambda v: F.when(F.size(v) > 0, F.sort_array(v)), vectors)


def attribute_irregular(entries: DataFrame, regular: DataFrame, adjudicated: DataFrame | None = None) -> DataFrame:
    """(surface, reading, ord, ch, reason): the irregular characters, or one row with the reason of a reject.

    ``entries``: surface, reading.  ``regular``: ch, form.  ``adjudicated``: reading, surface, ch.
    """
    keys = ["surface", "reading"]
    rows = entries.select(*keys)
    if adjudicated is not None:
        fixed = rows.join(adjudicated, keys).select(*keys, F.lit(0).alias("ord"), "ch", F.lit(None).cast("string").alias("reason"))
        rows = rows.join(adjudicated.select(*keys), keys, "left_anti")
    judged = (
        with_pieces(rows, keys, "surface", "reading", regular)
        .withColumn("runs", anchored_runs(F.col("surface"), F.col("reading")))
        .withColumn("best", F.transform("runs", lambda r: best_vectors(r["run"], r["part"], F.col("pieces"))))
    )
    reason = (
        F.when(F.col("runs").isNull(), "no kana anchor")
        .when(F.exists("best", lambda b: b.isNull()), "no split")
        .when(F.exists("best", lambda b: F.size(b) > 1), "ambiguous"))

    def odd(r: Column, i: Column) -> Column:
        vector = F.get(F.get(F.col("best"), i), F.lit(0))
        chars = F.regexp_extract_all(r["run"], F.lit("(?s:.)"), F.lit(0))
        return F.when(~F.contains(vector, F.lit("1")), chars).otherwise(
            F.filter(chars, lambda c, k: F.substring(vector, k + 1, F.lit(1)) == "0"))

    found = F.array_distinct(F.flatten(F.transform("runs", odd)))
    every = F.array_distinct(F.regexp_extract_all("surface", F.lit(f"[{CJK}]"), F.lit(0)))
    chars = F.when(F.size(found) > 0, found).otherwise(every)
    decided = judged.withColumn("reason", reason).withColumn("chars", F.when(F.col("reason").isNull(), chars))
    out = decided.select(*keys, F.posexplode_outer("chars").alias("ord", "ch"), "reason")
    return out if adjudicated is None else out.unionByName(fixed)


def sound_combinations(words: DataFrame, keys: list[str], surface: str, sounds: DataFrame, max_combos: int | None = 128) -> DataFrame:
    """(keys, sound): every reading of an all-character word from per-character sounds.

    Words with an unknown character, or more than ``max_combos`` combinations, give no rows: the
    bound is a rule of the operator, checked by counting before anything is combined. With None
    there is none, for words that were chosen by another rule.
    """
    chars = words.where(F.col(surface).rlike(r"^[\x{2E80}-\x{2EFF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]+$"))
    placed = chars.select(*keys, F.length(surface).alias("_n"), F.posexplode(F.regexp_extract_all(surface, F.lit("(?s:.)"), F.lit(0))).alias("at", "ch"))
    sizes = sounds.select("ch", "sound").distinct().groupBy("ch").agg(F.count(F.lit(1)).alias("k"))
    logs = placed.join(sizes, "ch").groupBy(*keys, "_n").agg(
        F.count(F.lit(1)).alias("m"), F.sum(F.log2(F.col("k").cast("double"))).alias("bits"))
    bound = F.lit(True) if max_combos is None else F.col("bits") <= math.log2(max_combos) + 1e-9
    few = logs.where((F.col("m") == F.col("_n")) & bound).select(*keys)
    kept = placed.join(few, keys, "left_semi").join(sounds.select("ch", "sound").distinct(), "ch")
    per = kept.groupBy(*keys, "at").agg(F.sort_array(F.collect_set("sound")).alias("s"))
    grid = per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "s"))).alias("g"))
    combined = F.aggregate(
        F.transform("g", lambda x: x["s"]), F.array(F.lit("")),
        lambda acc, s: F.array_distinct(F.flatten(F.transform(acc, lambda a: F.transform(s, lambda b: F.concat(a, b))))))
    return grid.select(*keys, F.explode(combined).alias("sound"))


def best_vector(df: DataFrame, keys: list[str], score: str, vector: str) -> DataFrame:
    """Highest score per key, its smallest vector, and whether another vector ties with it."""
    low = F.min(F.struct((-F.col(score)).alias("_neg"), F.col(vector)))
    high = F.max(F.struct(F.col(score), F.col(vector)))
    picked = df.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"))
    first, last = F.col(f"_low.{vector}"), F.col(f"_high.{vector}")
    return picked.select(*keys, F.col(f"_high.{score}").alias("score"), first.alias("vector"), (first != last).alias("ambiguous"))
