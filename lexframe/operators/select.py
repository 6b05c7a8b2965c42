"""Choosing and re-keying examples: residual readings, frequency selection, inflection keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.functions.text import geminated, kana_fold, kana_unfold, let, romanize, sound_forms
from lexframe.operators.attribute import CJK, with_pieces
from lexframe.operators.order import position, top_k
from lexframe.operators.verify import explode_targets
from lexframe.session import checkpointed

# --- fixed values: inflection tables ---
U_ROW = "うくぐすつぬぶむる"
NUMERALS = ("ひとつ", "ふたつ", "みつ", "みっつ", "よつ", "よっつ", "いつ", "いつつ", "むつ", "むっつ", "ななつ", "やつ", "やっつ", "ここのつ", "いくつ", "ます")
NOUNS = ("たがい", "さいわい", "わざわい", "いきおい", "たぐい")
CONTINUATIVE = (("う", "い"), ("く", "き"), ("ぐ", "ぎ"), ("す", "し"), ("つ", "ち"), ("ぬ", "に"), ("ぶ", "び"), ("む", "み"), ("る", "り"))
CANDIDATE_CAP = 4000
EXAMPLES_PER_READING = 3

TARGET_MARK = "\u0001"

_INTS = "cast(array() as array<int>)"
_STATES = "cast(array() as array<struct<p:int,o:int,n:int,res:string>>)"


def _tokens(surface: Column) -> Column:
    """Single characters and folded literals."""
    parts = F.regexp_extract_all(surface, F.lit(f"[{CJK}]|[^{CJK}]+"), F.lit(0))
    return F.transform(parts, kana_fold)


def _ends(total: Column, start: Column, rest: Column) -> Column:
    high = total - rest
    return F.when(high > start, F.sequence(start + 1, high)).otherwise(F.expr(_INTS))


def best_residual(df: DataFrame, keys: list[str], surface: str, reading: str, forms: DataFrame, targets: DataFrame) -> DataFrame:
    """(keys, residual): the reading left for target characters when the others take known forms.

    Among all placements the one covering most by other characters wins, then the shortest
    residual, then the smallest text.  Both measures add up along the word, so one best state per
    place is enough.  ``forms``: ch, form (geminated closure).  ``targets``: ch.
    """
    cols = list(dict.fromkeys([*keys, surface, reading]))
    # a target character is found by the mark below, any other one by its known forms
    marks = targets.select("ch", F.lit(TARGET_MARK).alias("form"))
    asked = df.withColumn("_asked", F.concat(F.col(reading), F.lit(TARGET_MARK)))
    rows = with_pieces(asked, [*cols, "_asked"], surface, "_asked", forms.select("ch", "form").unionByName(marks))
    # a piece is a character, a bar and a form
    rows = rows.withColumn("_reach", F.coalesce(F.array_max(F.transform("pieces", F.length)) - 2, F.lit(0)))
    r, total = F.col(reading), F.length(reading)
    start = F.expr("named_struct('left', 0, 'states', array(named_struct('p', 0, 'o', 0, 'n', 0, 'res', '')))")
    need = F.length(surface)

    def cut(p: Column, n: Column) -> Column:
        return F.substring(r, p + 1, n)

    def state(p, o, n, res) -> Column:
        return F.struct(p.alias("p"), o.alias("o"), n.alias("n"), res.alias("res"))

    def step(s: Column, t: Column) -> Column:
        # bound once per token: else they are worked out for every state and end
        return let(lambda base, target, left: walk(s, t, base, target, left), t.rlike(f"^[{CJK}]"),
                   F.array_contains(F.col("pieces"), F.concat(t, F.lit(f"|{TARGET_MARK}"))), s["left"] + F.length(t))

    def walk(s: Column, t: Column, base: Column, target: Column, left: Column) -> Column:
        rest = need - left

        def known(q: Column) -> Column:
            # only as far as the longest form of the word reaches
            reach = F.least(total - rest, q["p"] + F.col("_reach"))
            ends = F.when(reach > q["p"], F.sequence(q["p"] + 1, reach)).otherwise(F.expr(_INTS))
            fits = F.filter(ends, lambda e: F.array_contains(F.col("pieces"), F.concat(t, F.lit("|"), cut(q["p"], e - q["p"]))))
            return F.transform(fits, lambda e: state(e, q["o"] - e + q["p"], q["n"], q["res"]))

        def free(q: Column) -> Column:
            return F.transform(_ends(total, q["p"], rest), lambda e: state(e, q["o"], q["n"] + e - q["p"], F.concat(q["res"], cut(q["p"], e - q["p"]))))

        def literal(q: Column) -> Column:
            return F.when(cut(q["p"], F.length(t)) == t, F.array(state(q["p"] + F.length(t), q["o"], q["n"], q["res"]))).otherwise(F.expr(_STATES))

        grown = F.sort_array(F.flatten(F.when(~base, F.transform(s["states"], literal)).when(target, F.transform(s["states"], free)).otherwise(F.transform(s["states"], known))))
        # states come sorted by place: the first one of each is its best
        kept = let(lambda g: F.filter(g, lambda q, i: (i == 0) | (F.get(g, i - 1)["p"] != q["p"])), grown)
        return F.struct(left.alias("left"), kept.alias("states"))

    ended = F.aggregate(_tokens(F.col(surface)), start, step, lambda s: F.transform(F.filter(s["states"], lambda q: q["p"] == total), lambda q: q["res"]))
    # explode instead of a null filter: the filter would be pushed down and run the fold twice
    return rows.select(*keys, F.explode(F.slice(ended, 1, 1)).alias("residual"))


def unique_residual(df: DataFrame, keys: list[str], surface: str, reading: str, kanji: str, forms: DataFrame) -> DataFrame:
    """(keys, residual): the sound of ``kanji`` when the other characters fix it to exactly one.

    ``forms``: ch, form (known readings with all sound forms, none empty).
    """
    rows = df.where(F.length(surface) - F.length(F.replace(F.col(surface), F.col(kanji), F.lit(""))) == 1)
    rows = with_pieces(rows, list(dict.fromkeys([*keys, surface, reading, kanji])), surface, reading, forms)
    r, total, mine = F.col(reading), F.length(reading), F.col(kanji)
    start = F.expr("array(named_struct('p', 0, 'res', ''))")

    def cut(p: Column, e: Column) -> Column:
        return F.substring(r, p + 1, e - p)

    def step(states: Column, t: Column) -> Column:
        base = t.rlike(f"^[{CJK}]")

        def grow(q: Column) -> Column:
            ends = F.when(base, _ends(total, q["p"], F.lit(0))).when(
                F.substring(r, q["p"] + 1, F.length(t)) == t, F.array(q["p"] + F.length(t))).otherwise(F.expr(_INTS))
            fits = F.filter(ends, lambda e: ~base | (t == mine) | F.array_contains(F.col("pieces"), F.concat(t, F.lit("|"), cut(q["p"], e))))
            return F.transform(fits, lambda e: F.struct(e.alias("p"), F.when(t == mine, cut(q["p"], e)).otherwise(q["res"]).alias("res")))

        return F.array_distinct(F.flatten(F.transform(states, grow)))

    ended = F.aggregate(_tokens(F.col(surface)), start, step, lambda s: F.array_distinct(F.transform(
        F.filter(s, lambda q: (q["p"] == total) & (q["res"] != "")), lambda q: q["res"])))
    only = F.flatten(F.filter(F.array(ended), lambda v: F.size(v) == 1))
    return rows.select(*keys, F.explode(only).alias("residual"))


def geminated_forms(readings: DataFrame) -> DataFrame:
    """(ch, form) for best_residual: readings (ch, reading) folded, with the geminated tail."""
    return readings.select("ch", F.explode(geminated(kana_fold(F.col("reading")))).alias("form")).where("form <> ''").distinct()


def all_sound_forms(readings: DataFrame) -> DataFrame:
    """(ch, form) for unique_residual: geminated and voiced/devoiced forms of every reading."""
    folded = kana_fold(F.col("reading"))
    return readings.select("ch", F.explode(F.array_union(geminated(folded), sound_forms(folded))).alias("form")).where("form <> ''").distinct()


def select_examples(freq: DataFrame, dictionary: DataFrame, readings: DataFrame, targets: DataFrame, official: DataFrame,
                    cap: int | None = CANDIDATE_CAP, keep: int = EXAMPLES_PER_READING) -> DataFrame:
    """(ch, reading, best, place, rank, lemma, freq): frequency-based examples per character.

    ``freq``: lemma, form, freq.  ``dictionary``: surface, reading, reading_ord.  ``readings``: ch,
    reading (known readings of single characters).  ``official``: ch, key.  Only lemmas read with
    the official key count for a character that has one; its bucket stays even when it is empty
    (rank, lemma and freq null).  ``place`` orders the buckets of a character by their best frequency.
    """
    lemmas = explode_targets(freq.where("lemma <> ''"), targets)
    order = [F.desc("freq"), F.desc("lemma"), F.desc("form")]
    # without a cap every lemma is a candidate, and no character's lemmas need an order
    cand = (lemmas if cap is None else top_k(lemmas, ["ch"], order, cap, "_n")).where(~F.col("lemma").contains("・")).select("ch", "lemma", "form", "freq")
    known = dictionary.select(F.col("surface").alias("lemma"), F.col("reading").alias("_r"), "reading_ord")
    wanted = official.select("ch", F.col("key").alias("_key"), kana_fold(F.col("key")).alias("_hira"))
    asked = cand.join(known, "lemma", "left").join(wanted, "ch", "left").withColumn(
        "reading", kana_fold(F.coalesce("_r", F.when(F.col("form") != "", F.col("form"))))).where("reading is not null")
    asked = asked.withColumn("reading_ord", F.coalesce("reading_ord", F.lit(0).cast("long")))
    own = ["ch", "lemma", "form", "freq", "_key", "_hira"]
    # a residual is that of the word: worked out once, however many targets and forms it has
    pair = ["lemma", "reading"]
    asked = checkpointed(asked)
    solved = best_residual(asked.select(*pair).distinct(), pair, *pair, geminated_forms(readings), targets)
    found = asked.select(*own, "reading", "reading_ord").join(solved, pair).select(*own, "reading_ord", "residual")
    per = found.groupBy(*own).agg(
        F.max(F.col("residual") == F.col("_hira")).alias("_hit"), F.min(F.struct("reading_ord", "residual"))["residual"].alias("_free"))
    bucket = F.when(F.col("_key").isNull(), F.col("_free")).when(F.col("_hit"), F.col("_key"))
    best = per.select("ch", bucket.alias("reading"), "lemma", "freq").where("reading is not null").groupBy("ch", "reading", "lemma").agg(F.max("freq").alias("freq"))
    blank = wanted.select("ch", F.col("_key").alias("reading"), F.lit(None).cast("string").alias("lemma"), F.lit(None).cast("long").alias("freq"))
    ranked = top_k(best.unionByName(blank), ["ch", "reading"], [F.desc_nulls_last("freq"), F.desc("lemma")], keep, "rank")
    # at most ``keep`` rows are left per bucket, so these windows are small
    inside = Window.partitionBy("ch", "reading")
    sized = ranked.withColumn("best", F.coalesce(F.max("freq").over(inside), F.lit(0))).withColumn("_size", F.count(F.lit(1)).over(inside))
    kept = sized.where(F.col("lemma").isNotNull() | (F.col("_size") == 1))
    along = Window.partitionBy("ch").orderBy(F.desc("best"), "reading", "rank").rowsBetween(Window.unboundedPreceding, 0)
    placed = kept.withColumn("place", F.sum((F.col("rank") == 1).cast("int")).over(along))
    return placed.select("ch", "reading", "best", "place", F.when(F.col("lemma").isNotNull(), F.col("rank")).alias("rank"), "lemma", "freq")


def rekey_examples(df: DataFrame, dictionary: DataFrame, readings: DataFrame, on_readings: DataFrame) -> DataFrame:
    """Route every example to the key its word is really read with.

    ``df``: ch, reading, ord, w.  ``dictionary``: surface, reading, reading_ord.  ``readings``: ch,
    reading.  ``on_readings``: ch, value (romanised).  Returns ch, bucket (readings / except), key,
    from_reading, ord, w, moved.  A character left without any reading takes its moved exceptions back.
    """
    keys = ["ch", "reading", "w"]
    known = dictionary.select(F.col("surface").alias("w"), kana_fold(F.col("reading")).alias("known"), "reading_ord")
    pairs = df.select(*keys).distinct()
    asked = pairs.join(known, "w")
    solved = unique_residual(asked.select("ch", "w", "known").distinct(), ["ch", "w", "known"], "w", "known", "ch", all_sound_forms(readings))
    forms = sound_forms(F.col("reading"))
    judged = asked.join(solved, ["ch", "w", "known"], "left").withColumn("forms", forms)
    heard = F.exists("forms", lambda f: F.contains(F.col("known"), f)) | F.coalesce(F.array_contains(F.col("forms"), F.col("residual")), F.lit(False))
    verdict = judged.groupBy(*keys).agg(
        F.max(heard).alias("heard"), F.min(F.when(F.col("residual").isNotNull(), F.struct("reading_ord", "residual")))["residual"].alias("sound"),
        F.min(F.struct("reading_ord", "known"))["known"].alias("first"))
    on = on_readings.select("ch", F.col("value").alias("_roman"), F.lit(True).alias("_on"))
    spelt = verdict.withColumn("_roman", romanize(F.col("sound"))).join(on.distinct(), ["ch", "_roman"], "left")
    key = F.when(F.col("heard"), F.col("reading")).when(F.col("sound").isNull(), F.col("first")).when(
        F.col("_on"), kana_unfold(F.col("sound"))).otherwise(F.col("sound"))
    bucket = F.when(~F.col("heard") & F.col("sound").isNull(), "except").otherwise("readings")
    routed = df.join(spelt.select(*keys, key.alias("key"), bucket.alias("bucket"), (~F.col("heard")).alias("moved")), keys, "left")
    routed = routed.select(
        "ch", F.coalesce("bucket", F.lit("readings")).alias("bucket"), F.coalesce("key", "reading").alias("key"),
        F.col("reading").alias("from_reading"), "ord", "w", F.coalesce("moved", F.lit(False)).alias("moved"))
    left = routed.where("bucket = 'readings'").select("ch").distinct().withColumn("_left", F.lit(True))
    return routed.join(left, "ch", "left").withColumn(
        "bucket", F.when(F.col("_left").isNull(), "readings").otherwise(F.col("bucket"))).drop("_left")


def infer_reading_key(df: DataFrame) -> DataFrame:
    """(ch, reading, key, method) from example surfaces.

    ``df``: ch, reading, ord, example (evidence rows come with later ords and are only read here).
    The longest okurigana that ends the reading wins, the earliest on ties; else a one-character
    continuative form; else the reading stays as it is.
    """
    keys = ["ch", "reading"]
    last = F.substring("reading", -1, 1)
    inflected = (F.col("reading") != "") & ~F.col("reading").isin(*NUMERALS, *NOUNS) & last.isin(*U_ROW, "い")
    surface = F.trim(F.regexp_replace("example", "（[ぁ-ゖゝゞァ-ヺヽヾー]+）|　", ""))
    tails = F.regexp_extract_all(surface, F.concat(F.lit("\\Q"), F.col("ch"), F.lit("\\E([ぁ-ゖゝゞー]*)")), F.lit(1))
    seen = df.where(inflected).select(*keys, "ord", F.posexplode(tails).alias("at", "suffix")).where("suffix <> ''")
    expected = F.create_map(*[F.lit(x) for pair in CONTINUATIVE for x in pair])
    ends, n = F.col("reading").endswith(F.col("suffix")), F.length("suffix")
    exact = F.when(ends & (F.length("reading") > n), F.struct((-n).alias("neg"), "ord", "at"))
    renyo = F.when(~ends & (n == 1) & (F.try_element_at(expected, last) == F.col("suffix")) & (F.length("reading") > 1), F.lit(True))
    proof = seen.groupBy(*keys).agg(F.min(exact).alias("exact"), F.max(renyo).alias("renyo"))
    size = F.length("reading")
    joined = df.select(*keys).distinct().join(proof, keys, "left")
    key = F.when(F.col("exact").isNotNull(), F.concat(F.substring("reading", F.lit(1), size + F.col("exact.neg")), F.lit("ー"))).when(
        F.col("renyo"), F.concat(F.substring("reading", F.lit(1), size - 1), F.lit("ー"))).otherwise(F.col("reading"))
    method = F.when(~inflected, "plain").when(F.col("exact").isNotNull(), "surface").when(F.col("renyo"), "renyo").otherwise("uninflected")
    return joined.select(*keys, key.alias("key"), method.alias("method"))


def merge_rows(df: DataFrame, keys: list[str], order: list[str], bucket: Column, name: str = "ord") -> DataFrame:
    """Order-preserving merge of rows that resolve to the same key, kept flat: a new ordinal per key."""
    return position(df, keys, order, bucket, name)


def ordered_distinct(df: DataFrame, keys: list[str], value: str, order: list[str], bucket: Column, name: str = "ord") -> DataFrame:
    """Values per key in order of first appearance, each once; flat with an ordinal."""
    first = df.withColumn("_b", bucket.cast("long")).groupBy(*keys, value).agg(F.min(F.struct("_b", *order)).alias("_at"))
    ranked = position(first, keys, ["_at", value], F.col("_at._b"), name)
    return ranked.select(*keys, name, value)
