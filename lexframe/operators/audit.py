"""Whole-dataset audits: comparisons inside groups, conflicts across keys, tallies and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import branches, compare_form, drop_brackets, first_sense, has_boundary_semicolon, has_digit, let, senses
from lexframe.operators.order import top_k
from lexframe.operators.similar import char_set, first_similar, jaccard
from lexframe.session import checkpointed

SIMILAR = 0.8
MANY_COMMAS = 2


def compare_pairs(df: DataFrame, group: list[str]) -> DataFrame:
    """First clashing pair per group: (group, a, b, severity, reason); ``df``: group, ord, meaning, why.

    The first pair in order is always found among: the two first rows of one normal form, of one
    first sense or of one character set, and pairs of first rows of two similar character sets.
    (An earlier row with the same set would itself open an earlier pair.)  So nothing is paired off
    beyond sets sharing rare characters.
    """
    norm = compare_form(F.col("meaning"))
    # read by every branch below
    rows = checkpointed(df.withColumn("norm", norm).withColumn("first", first_sense(F.col("meaning"))).withColumn("chars", char_set(norm)))

    def two_first(keys: list[str]) -> DataFrame:
        two = top_k(rows.select(*group, *keys, "ord"), [*group, *keys], [F.col("ord")], 2, "_k")
        pair = two.groupBy(*group, *keys).agg(F.min("ord").alias("a"), F.max("ord").alias("b"))
        return pair.where("a < b").select(*group, "a", "b")

    heads = rows.groupBy(*group, "chars").agg(F.min("ord").alias("ord"))
    near = first_similar(heads.where(F.size("chars") > 0), group, "ord", "chars", SIMILAR)
    found = two_first(["chars"]).unionByName(two_first(["first"])).unionByName(near)
    best = found.groupBy(*group).agg(F.min(F.struct("a", "b")).alias("p")).select(*group, "p.a", "p.b")

    def side(name: str) -> DataFrame:
        return rows.select(*group, F.col("ord").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("meaning", "why", "norm", "first", "chars")])

    both = best.join(side("a"), [*group, "a"]).join(side("b"), [*group, "b"])
    same = (F.col("a_meaning") == F.col("b_meaning")) | (F.col("a_norm") == F.col("b_norm"))
    why_a, why_b = F.trim(F.coalesce("a_why", F.lit(""))), F.trim(F.coalesce("b_why", F.lit("")))
    distinct = (why_a != "") & (why_b != "") & (compare_form(why_a) != compare_form(why_b))
    reason = F.when(same & distinct, "same meaning, distinct reasons").when(same, "same meaning, no reason").when(
        F.col("a_first") == F.col("b_first"), "same first sense").otherwise("nearly the same meaning")
    severity = F.when(same & ~distinct, "FAIL").otherwise("WARN")
    return both.select(*group, "a", "b", severity.alias("severity"), reason.alias("reason"))


def audit_meanings(df: DataFrame, keys: list[str], meaning: str, max_senses: int = 3) -> DataFrame:
    """(keys, severity, reason): sense-syntax findings per example."""
    m = F.col(meaning)
    lines = senses(m)
    def rule(cond: Column, severity: str, reason: str) -> Column:
        return F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(reason).alias("reason")))
    found = F.array_compact(F.array(
        rule(has_boundary_semicolon(m), "FAIL", "semicolon between senses"),
        rule(F.size(lines) > max_senses, "FAIL", "too many senses"),
        rule(F.exists(lines, lambda x: F.regexp_count(x, F.lit("[,·/]")) >= MANY_COMMAS), "WARN", "many commas in one sense"),
        rule(F.exists(lines, lambda x: x.rlike("[(（][^)）]*[)）]")), "ASK", "brackets left"),
    ))
    return df.select(*keys, F.explode(found).alias("f")).select(*keys, "f.severity", "f.reason")


def described_sense(sense: Column, sounds: Column) -> Column:
    """What a sense is compared by.  ``sounds``: array of plain transliterations."""
    return let(lambda norm: F.struct(
        F.array_contains(sounds, sense).alias("sound"), F.trim(drop_brackets(sense)).alias("bare"), norm.alias("norm"), char_set(norm).alias("chars"),
        has_digit(sense).alias("digit"), F.length(sense).alias("n")), compare_form(sense))


def redundant_reason(left: Column, right: Column) -> Column:
    """Why two described senses say the same without judgement, or null."""
    low, high = F.least(F.size(left["chars"]), F.size(right["chars"])), F.greatest(F.size(left["chars"]), F.size(right["chars"]))
    # sets of too different sizes cannot be similar, whatever they hold
    near = F.when(low >= high * SIMILAR - 1e-9, jaccard(left["chars"], right["chars"]) >= SIMILAR)
    return (
        F.when(left["sound"] & ~right["sound"], "first is a transliteration").when(right["sound"] & ~left["sound"], "second is a transliteration")
        .when((left["digit"] != right["digit"]) & (F.greatest(left["n"], right["n"]) <= 6), "digits beside words")
        .when((left["bare"] != "") & (left["bare"] == right["bare"]), "same without brackets").when(left["norm"] == right["norm"], "same")
        .when(near, "nearly the same letters"))


def audit_redundancy(df: DataFrame, keys: list[str], lines: str, sounds: str) -> DataFrame:
    """(keys, at, other, reason): first redundant pair of senses inside one example.

    The senses are one row's own short list, compared in place; each is described once, and nothing
    is compared behind the first pair.
    """
    none = F.expr("cast(null as struct<at:int,other:int,reason:string>)")

    def scan(senses: Column) -> Column:
        def pair(x: Column, at: Column, other: Column) -> Column:
            return let(lambda reason: F.when(reason.isNotNull(), F.struct(at.alias("at"), other.alias("other"), reason.alias("reason"))), redundant_reason(x, F.get(senses, other)))

        def first_of(at: Column) -> Column:
            others = F.when(at < F.size(senses) - 1, F.sequence(at + 1, F.size(senses) - 1))
            return let(lambda x: F.aggregate(others, none, lambda acc, other: F.when(acc.isNotNull(), acc).otherwise(pair(x, at, other))), F.get(senses, at))

        every = F.when(F.size(senses) > 1, F.sequence(F.lit(0), F.size(senses) - 1))
        return F.array_compact(F.array(F.aggregate(every, none, lambda acc, at: F.when(acc.isNotNull(), acc).otherwise(first_of(at)))))

    described = F.transform(lines, lambda x: described_sense(x, F.col(sounds)))
    return df.select(*keys, F.explode(let(scan, described)).alias("p")).select(*keys, "p.at", "p.other", "p.reason")


def cross_key_conflicts(df: DataFrame, surface: list[str], key: str, value: str) -> DataFrame:
    """Rows whose surface stands under several keys with several values (min and max differ)."""
    sides = df.groupBy(*surface).agg(
        (F.min(key) != F.max(key)).alias("_k"), (F.min(value) != F.max(value)).alias("_v")).where("_k and _v")
    return df.join(sides.select(*surface), surface, "left_semi")


def suppress_exceptions(regular: DataFrame, exceptions: DataFrame, scope: list[str], word: str = "w") -> DataFrame:
    """Regular examples without the branches that are also exceptions of the same scope.

    ``regular``: scope, id, w.  ``exceptions``: scope, w.  Returns scope, id, surface, reading,
    changed; rows that cannot be analysed stay as they are, rows losing all branches disappear.
    """
    parsed = regular.withColumn("_b", branches(F.col(word)))
    opened = parsed.select(*scope, "id", word, F.posexplode_outer("_b").alias("at", "b"))
    banned = exceptions.select(*scope, F.explode(branches(F.col(word))).alias("b")).select(
        *scope, F.col("b.surface").alias("_s"), F.col("b.local").alias("_r"), F.lit(True).alias("_hit")).distinct()
    options = opened.select(*scope, "id", "at", F.col("b.surface").alias("_s"), F.explode("b.options").alias("_r"))
    hits = options.join(banned, [*scope, "_s", "_r"]).select(*scope, "id", "at", F.lit(True).alias("_hit")).distinct()
    judged = opened.join(hits, [*scope, "id", "at"], "left")
    kept = F.struct("at", F.col("b.surface").alias("s"), F.col("b.reading").alias("r"))
    per = judged.groupBy(*scope, "id", word).agg(
        F.sort_array(F.collect_list(F.when(F.col("_hit").isNull() & F.col("at").isNotNull(), kept))).alias("k"),
        F.count("at").alias("n"))
    return per.where((F.size("k") > 0) | (F.col("n") == 0)).select(
        *scope, "id", F.when(F.col("n") == 0, F.regexp_replace(word, r"\([^)]*\)", "")).otherwise(
            F.array_join(F.transform("k", lambda x: x["s"]), "・")).alias("surface"),
        F.array_join(F.transform("k", lambda x: x["r"]), "・").alias("reading"), (F.size("k") < F.col("n")).alias("changed"))


def tally(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts per combination and their share of all rows in millionths."""
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", F.floor(F.col("n") * 1000000 / total))


def report(df: DataFrame, by: list[str], order: list[Column], n: int = 40) -> DataFrame:
    """First rows per group with the number of rows left out."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    shown = top_k(df, by, order, n, "line")
    return shown.join(sizes, by).withColumn("more", F.greatest(F.col("_n") - n, F.lit(0))).drop("_n")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Reproducible sample: the n smallest md5 sums of key and seed; a top-n, so nothing is sorted as a whole."""
    mark = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", mark).orderBy("_h", key).limit(n).drop("_h")


def audit_sample(df: DataFrame, verdicts: DataFrame, key: str, cols: list[str], n: int, seed: int) -> DataFrame:
    """Tally of supplied verdicts over a reproducible sample."""
    sampled = seeded_sample(df, key, n, seed)
    return tally(sampled.join(verdicts, key, "left"), cols)
