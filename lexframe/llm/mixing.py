"""Mixing sources to target weights along a time-varying curriculum.

Targets: the sources share a budget by weight, none takes more than ``most`` times its own size, and
the excess is shared anew by weight until none is above. Each source's weight moves along a piecewise
linear schedule over training time 0 to 1. Its integral is the share of the source's demand used up
by then; inverted at the tokens that lie before a document in its source, it gives the document's
training position. Range-sorting by position yields the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.llm.common import SPACE_CLASS, checkpointed, named, packed_row, unpacked

WEIGHTS = (5, 2, 1)
#: schedules of the weights above: (time, factor) knots; the first fades out, the last fades in
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25)))
BUDGET = 1.5
MOST = 2
#: hash buckets over which the documents of one source are dealt for their running sums
BUCKETS = 4096


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda w: w != "")).cast("long")


def integrated(knots: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float]]:
    """Segments (start, weight, slope, used) of a schedule scaled to integral 1; ``used`` is the integral before."""
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])) or min(w for _, w in knots) <= 0:
        raise ValueError("knots rise from time 0 to 1 with positive weights")
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, used, out = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        out.append((t0, w0 / total, (w1 - w0) / (t1 - t0) / total, used))
        used += area / total
    return out


def inverted(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the schedule's integral reaches ``share`` (0 to 1)."""
    time: Column | None = None
    for start, weight, slope, used in integrated(knots):
        rest = share - used
        # weight * x + slope * x^2 / 2 = rest, in the form that stays exact for slope 0
        x = F.lit(start) + 2 * rest / (weight + F.sqrt(F.greatest(F.lit(weight * weight) + 2 * slope * rest, F.lit(0.0))))
        time = x if time is None else F.when(share >= used, x).otherwise(time)
    return F.least(F.greatest(time, F.lit(0.0)), F.lit(1.0))


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place`` from 0 in code point order, null last, numbered range by range."""
    ranged = checkpointed(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("__part", F.spark_partition_id()))
    parts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("__part").orderBy(F.col("source").asc_nulls_last())
    return ranged.withColumn("__i", F.row_number().over(within) - 1).join(bases, "__part").withColumn("place", F.col("__base") + F.col("__i")).drop("__part", "__i", "__base")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """Per source of ``sizes`` (source, size): source_size, place, weight and target.

    Each round shares what the capped sources leave by the weights of the others, on the driver only
    as three sums; it ends when no further source is capped. Sources without words get 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = _ranked(totals)
    cycle = F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("place"), F.lit(len(weights))).cast("int"))
    placed = checkpointed(placed.withColumn("weight", cycle))
    whole = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, capped = 0.0, -1
    while True:
        is_capped = F.col("source_size") * most <= F.lit(level) * F.col("weight")
        number, held, open_weight = placed.agg(
            F.coalesce(F.sum(is_capped.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(is_capped, F.col("source_size") * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("weight"))), F.lit(0)),
        ).first()
        if number == capped or not open_weight:
            break
        capped, level = number, (budget * whole - held) / open_weight
    cap = (F.col("source_size") * most).cast("double")
    return placed.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if open_weight else cap)


def curriculum(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES, budget: float = BUDGET, most: int = MOST, buckets: int = BUCKETS, text: str = "text", key: str = "doc_id", passes: bool = False) -> DataFrame:
    """The other columns of ``docs`` with size, source_size, target, taken and positions, a row per row.

    Documents of a source stand in the order of a hash. The source's demand runs over that order up to
    ``most`` times, so a document is taken whole in each pass that reaches it; where the demand ends
    inside a document, ``taken`` counts its words up to there. ``positions`` lists the training
    position of every pass, ascending; documents not taken have none. Null and empty texts have size 0
    and are never taken; a null source is a source of its own, the last. An empty table stays empty.
    Repeated rows are separate rows. Columns named like a result are replaced.

    Without ``passes``, ``text`` is not returned. With it, the result is the training set: all columns
    of ``docs`` with a row per pass that takes words, its words (pass_words), size and position.
    """
    results = ("size", "source_size", "target", "taken", "positions", "position", "pass_words")
    kept = [c for c in docs.columns if c.lower() not in results and (passes or c.lower() not in (text.lower(), "source"))]
    # 60 bits of an md5 sum, which other engines have as well
    order = F.conv(F.substring(F.md5(F.concat_ws("|", named(key).cast("string"), named(text))), 1, 15), 16, 10).cast("long")
    keys = [F.xxhash64(named(key), named(text)).alias("__tie"), order.alias("__order")]
    # whole texts are not copied: with passes they join in again by these hashes
    row = packed_row([] if passes else kept).alias("__row")
    sized = checkpointed(docs.select(row, named("source").alias("__source"), size_of(named(text)).alias("size"), *keys))
    sized = sized.withColumn("__bucket", F.shiftrightunsigned(F.col("__order"), 60 - (buckets - 1).bit_length()))
    goal = targets(sized.select(F.col("__source").alias("source"), "size"), weights, budget, most)
    sums = sized.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum"))
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("__source").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"))
    goals = goal.select(F.col("source").alias("__g"), "source_size", "place", "target")
    bases = bases.join(goals, bases["__s"].eqNullSafe(goals["__g"]))
    inside = Window.partitionBy("__source", "__bucket").orderBy("__order", "__tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = placed.join(bases, placed["__source"].eqNullSafe(bases["__s"]) & (placed["__bucket"] == bases["__b"]))
    demand = F.round("target").cast("long")

    def spent(p: int) -> Column:
        return F.col("__base") + F.col("__in") + F.col("source_size") * p

    def at(p: int) -> Column:
        """(pass_words, position) of a pass that takes words, else null."""
        share = spent(p) / F.col("target")
        position: Column | None = None
        for i, knots in enumerate(schedules):
            own = inverted(share, knots)
            position = own if position is None else F.when(F.pmod("place", F.lit(len(schedules))) == i, own).otherwise(position)
        words = F.least(F.col("size"), demand - spent(p))
        return F.when(words > 0, F.struct(words.alias("pass_words"), position.alias("position")))

    took = F.filter(F.array(*[at(p) for p in range(most)]), lambda x: x.isNotNull())
    if passes:
        # rows equal in all of these are copies of one row: copy and share of the demand meet by number
        same = ["__order", "__tie", "source"]
        number = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
        shares = both.select("__order", "__tie", placed["__source"].alias("source"), "size", took.alias("__took")).withColumn("__n", number)
        slots = shares.select("__order", "__tie", F.col("source").alias("__s"), "__n", "size", F.inline("__took"))
        texts = docs.select(packed_row(kept).alias("__row"), named("source").alias("source"), *keys).withColumn("__n", number)
        on = [texts[c] == slots[c] for c in ("__order", "__tie", "__n")] + [texts["source"].eqNullSafe(slots["__s"])]
        return texts.join(slots, on).select(*unpacked("__row", kept), "size", "pass_words", "position")
    taken = F.aggregate("__took", F.lit(0).cast("long"), lambda a, x: a + x["pass_words"])
    both = both.withColumn("__took", took)
    return both.select(
        *unpacked("__row", kept), placed["__source"].alias("source"), "size", "source_size", "target",
        taken.alias("taken"), F.transform("__took", lambda x: x["position"]).alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """Range-sorted by the first position; documents not taken come last."""
    first = F.get("positions", 0).alias("position")
    return mixed.select(*map(named, mixed.columns), first).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def _inverted_sql(knots: tuple[tuple[float, float], ...]) -> str:
    cases = [
        f"WHEN share >= {used!r} THEN {start!r} + 2 * (share - {used!r}) / ({weight!r} + sqrt(greatest({weight * weight!r} + 2 * {slope!r} * (share - {used!r}), 0)))"
        for start, weight, slope, used in reversed(integrated(knots))
    ]
    return f"CASE {' '.join(cases)} END"


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACE_CLASS}]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS o
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS weight FROM s),
r AS (
  SELECT *, {MOST} * source_size / weight AS ratio, {BUDGET} * sum(source_size) OVER () AS total,
         coalesce(sum({MOST} * source_size) OVER (ORDER BY {MOST} * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY {MOST} * source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w),
l AS (SELECT min_by((total - held) / open, (ratio, place)) AS level FROM r WHERE ratio > (total - held) / open),
t AS (SELECT w.*, least(({MOST} * source_size)::DOUBLE, coalesce(level * weight, {MOST} * source_size))::DOUBLE AS target FROM w, l),
a AS (
  SELECT d.*, source_size, target, place, round(target)::BIGINT AS demand,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (
  SELECT *, {" + ".join(f"greatest(0, least(size, demand - start - {p} * source_size))" for p in range(MOST))} AS taken,
         CASE WHEN size > 0 AND start < demand THEN start / target END AS share
  FROM a)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       round(CASE WHEN share IS NOT NULL THEN least(greatest(CASE place % {len(SCHEDULES)} {" ".join(f"WHEN {i} THEN {_inverted_sql(k)}" for i, k in enumerate(SCHEDULES))} END, 0), 1) END, 9) AS position
FROM b"""
