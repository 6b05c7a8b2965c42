"""Set-similarity joins by prefixes with places and by deletions: no group is ever paired off completely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import let
from lexframe.operators.order import top_k
from lexframe.session import checkpointed

#: sets of up to so many tokens meet by what is left of them after deletions
SMALL = 10


def similar_sets(df: DataFrame, group: list[str], row: str, tokens: str, threshold: float) -> DataFrame:
    """(group, a, b, overlap) for rows a < b of one group whose token sets reach the Jaccard threshold.

    Tokens are ordered by how rare they are; two sets that reach the threshold must share a token
    among the first ``n - ceil(threshold * n) + 1`` of either set, so only rows sharing such a rare
    token meet.
    """
    spread = df.select(*group, F.col(row).alias("_row"), F.explode(tokens).alias("_t"))
    counts = spread.groupBy("_t").agg(F.count(F.lit(1)).alias("_c"))
    ordered = spread.join(counts, "_t").groupBy(*group, "_row").agg(
        F.sort_array(F.collect_list(F.struct("_c", "_t"))).alias("_o"))
    ordered = ordered.select(*group, "_row", F.transform("_o", lambda x: x["_t"]).alias("_s"))
    n = F.size("_s")
    prefix = F.slice("_s", F.lit(1), (n - F.ceil(F.round(n * F.lit(threshold), 6)) + 1).cast("int"))
    keyed = ordered.select(*group, "_row", "_s", F.posexplode(prefix).alias("_at", "_p"))
    left = keyed.select(*group, "_p", F.col("_row").alias("a"), F.col("_s").alias("_sa"), F.col("_at").alias("_pa"))
    right = keyed.select(*group, "_p", F.col("_row").alias("b"), F.col("_s").alias("_sb"), F.col("_at").alias("_pb"))
    na, nb = F.size("_sa"), F.size("_sb")
    # the shared token and what follows it on the shorter side is all that the two can have in common from here on
    reach = F.least("_pa", "_pb") + F.least(na - F.col("_pa"), nb - F.col("_pb"))
    fits = (F.col("a") < F.col("b")) & (na >= nb * threshold) & (nb >= na * threshold) & (F.round(reach * (1 + threshold), 6) >= F.round((na + nb) * threshold, 6))
    shared = F.size(F.array_intersect("_sa", "_sb"))
    overlap = shared / (F.size("_sa") + F.size("_sb") - shared)
    # a pair sharing several prefix tokens is kept at the first one both prefixes hold
    met = left.join(right, [*group, "_p"]).where(fits)
    return met.select(*group, "a", "b", overlap.alias("overlap")).where(F.col("overlap") >= threshold).distinct()


def _without(s: Column, number: int, start: Column | None = None) -> Column:
    """Every array that is left of ``s`` after ``number`` deletions, from place ``start`` on."""
    if number == 0:
        return F.array(s)
    first = F.lit(0) if start is None else start
    places = F.when(F.size(s) > first, F.sequence(first, F.size(s) - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    def fewer(k: Column) -> Column:
        rest = F.concat(F.slice(s, F.lit(1), k), F.slice(s, k + 2, F.size(s)))
        return F.array(rest) if number == 1 else let(lambda t, at: _without(t, number - 1, at), rest, k)

    return F.flatten(F.transform(places, fewer))


def first_similar(df: DataFrame, group: list[str], row: str, tokens: str, threshold: float) -> DataFrame:
    """(group, a, b): of the rows a < b of a group whose token sets reach the threshold, the first pair.

    ``df`` holds each token set of a group once. What two sets share is each of them after i and j
    deletions, and the threshold holds if i + j is small against it; so sets of up to SMALL tokens (and
    the larger ones near them) meet in what is left of them. Of each such meeting only the two first
    rows of every i can open the first pair. Pairs of two larger sets come from ``similar_sets``.
    """
    spare = (1 - threshold) / threshold
    n = F.size("_s")
    most = int(SMALL / threshold + 1e-6)
    sets = checkpointed(df.select(*group, F.col(row).alias("_row"), F.sort_array(tokens).alias("_s")))

    def left_over(i: int) -> Column:
        # i deletions are of use only while they are few against what is left
        useful = (F.floor(F.round((n - i) * spare, 6)) >= i) & (n - i <= SMALL) & (n - i > 0)
        made = F.transform(let(lambda s: _without(s, i), F.col("_s")), lambda x: F.struct(F.array_join(x, "\x1f").alias("sig"), F.lit(i).alias("i"), F.size(x).alias("m")))
        return F.when(useful & (n <= most), made).otherwise(F.expr("cast(array() as array<struct<sig:string,i:int,m:int>>)"))

    deletions = range(int(most * spare / (1 + spare) + 1e-6) + 1)
    spread = sets.select(*group, "_row", F.inline(F.concat(*[left_over(i) for i in deletions])))
    two = top_k(spread, [*group, "sig", "i"], [F.col("_row")], 2, "_k")
    met = two.groupBy(*group, "sig").agg(F.first("m").alias("m"), F.sort_array(F.collect_list(F.struct("_row", "i"))).alias("l")).where(F.size("l") > 1)

    def pairs(x: Column, at: Column) -> Column:
        later = F.filter(F.slice(F.col("l"), at + 2, F.size("l")), lambda y: (y["_row"] > x["_row"]) & (x["i"] + y["i"] <= F.floor(F.round(F.col("m") * spare, 6))))
        return F.transform(later, lambda y: F.struct(x["_row"].alias("a"), y["_row"].alias("b")))

    near = met.select(*group, F.array_min(F.flatten(F.transform("l", pairs))).alias("p")).where("p IS NOT NULL").select(*group, "p.a", "p.b")
    large = similar_sets(sets.where(n > SMALL), group, "_row", "_s", threshold).select(*group, "a", "b")
    return near.unionByName(large).groupBy(*group).agg(F.min(F.struct("a", "b")).alias("p")).select(*group, "p.a", "p.b")


def char_set(c: Column) -> Column:
    return F.sort_array(F.array_distinct(F.regexp_extract_all(c, F.lit("(?s:.)"), F.lit(0))))


def jaccard(a: Column, b: Column) -> Column:
    shared, total = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)
