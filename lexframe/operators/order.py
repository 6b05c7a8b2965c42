"""Order-dependent columns that never put one key's rows into one task.

Every function takes ``bucket``: a column that does not decrease along ``order`` inside a key
(for example ``id div 4096``).  Rows are windowed per (keys, bucket); what earlier buckets
contribute comes from a per-bucket summary, so a key holding a third of all rows still spreads
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.session import checkpointed

Cols = list[str]
#: buckets that share one row of the upper level of a running sum
SUMMARY = 1024


def _names(df: DataFrame, keys: Cols, bucket: Column) -> DataFrame:
    return df.withColumn("_bucket", bucket.cast("long"))


def running_sum(df: DataFrame, keys: Cols, order: Cols, bucket: Column, value: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order``."""
    rows = _names(df, keys, bucket).withColumn("_value", value.cast("long"))
    parts = rows.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_part")).withColumn("_top", F.floor(F.col("_bucket") / SUMMARY))
    # two levels: no task sees more than SUMMARY buckets of a key, or one row per SUMMARY buckets
    across = Window.partitionBy(*keys).orderBy("_top").rowsBetween(Window.unboundedPreceding, -1)
    tops = parts.groupBy(*keys, "_top").agg(F.sum("_part").alias("_sum")).withColumn("_above", F.coalesce(F.sum("_sum").over(across), F.lit(0))).drop("_sum")
    before = Window.partitionBy(*keys, "_top").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.withColumn("_carry", F.coalesce(F.sum("_part").over(before), F.lit(0))).join(tops, [*keys, "_top"])
        .select(*keys, "_bucket", (F.col("_carry") + F.col("_above")).alias("_carry"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_local", F.sum("_value").over(inside))
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.col("_local") + F.col("_carry"))
        .drop("_bucket", "_value", "_local", "_carry")
    )


def position(df: DataFrame, keys: Cols, order: Cols, bucket: Column, name: str = "pos") -> DataFrame:
    """1-based position per key in ``order`` (a total order)."""
    return running_sum(df, keys, order, bucket, F.lit(1), name)


def ranged(df: DataFrame, keys: Cols, order: Cols, name: str = "_range") -> DataFrame:
    """``df`` with a bucket column cut from the data: ranges of (keys, order) of about equal size.

    Spark samples the rows for the cuts, so the ranges are even whatever values a column has, and a
    key with many rows spans many of them. Materialised, since another sample would cut elsewhere.
    """
    return checkpointed(df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id()))


def ranged_position(df: DataFrame, keys: Cols, order: Cols, name: str = "pos") -> DataFrame:
    """1-based position per key in ``order`` (a total order), by ranges of the data itself."""
    return position(ranged(df, keys, order), keys, order, F.col("_range"), name).drop("_range")


def carried_value(df: DataFrame, keys: Cols, order: Cols, bucket: Column, value: Column, name: str, forward: bool = True) -> DataFrame:
    """Last non-null ``value`` up to and including the row (or the next one when not ``forward``)."""
    rows = _names(df, keys, bucket).withColumn("_value", value)
    at = F.struct(*order)
    ranked = F.when(F.col("_value").isNotNull(), at)
    pick = F.max_by("_value", ranked) if forward else F.min_by("_value", ranked)
    edge = Window.partitionBy(*keys).orderBy("_bucket")
    if forward:
        carry = F.last("_edge", ignorenulls=True).over(edge.rowsBetween(Window.unboundedPreceding, -1))
        frame = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        local = F.last("_value", ignorenulls=True).over(frame)
    else:
        carry = F.first("_edge", ignorenulls=True).over(edge.rowsBetween(1, Window.unboundedFollowing))
        frame = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
        local = F.first("_value", ignorenulls=True).over(frame)
    edges = (
        rows.groupBy(*keys, "_bucket").agg(pick.alias("_edge"))
        .withColumn("_carry", carry).drop("_edge")
    )
    return (
        rows.withColumn("_local", local)
        .join(edges, [*keys, "_bucket"])
        .withColumn(name, F.coalesce("_local", "_carry"))
        .drop("_bucket", "_value", "_local", "_carry")
    )


def entry_keys(df: DataFrame, head: str, order: Cols, bucket: Column, name: str = "key") -> DataFrame:
    """Homograph-safe keys: the first stays bare, later ones get ``#n``."""
    ranked = position(df, [head], order, bucket, "_nth")
    return ranked.withColumn(
        name, F.when(F.col("_nth") == 1, F.col(head)).otherwise(F.concat(F.col(head), F.lit("#"), F.col("_nth").cast("string")))
    ).drop("_nth")


def first_occurrence(df: DataFrame, keys: Cols, order: Cols) -> DataFrame:
    """First row per key in source order; combines before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) if c not in keys else F.col(c) for c in rest]).select(*df.columns)


def top_k(df: DataFrame, keys: Cols, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """Bounded top-k per key; Spark limits each group before the shuffle as well as after it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def batch_ids(df: DataFrame, order: Cols, bucket: Column, size: int, group: Cols | None = None, name: str = "batch") -> DataFrame:
    """Batches of ``size`` rows in order, or of ``size`` whole groups when ``group`` is given."""
    if group is None:
        return position(df.withColumn("_all", F.lit(0)), ["_all"], order, bucket, "_n").withColumn(
            name, F.floor((F.col("_n") - 1) / size)).drop("_n", "_all")
    heads = df.withColumn("_bucket0", bucket.cast("long")).groupBy(*group).agg(F.min(F.struct("_bucket0", *order)).alias("_at"))
    heads = heads.withColumn("_b", F.col("_at._bucket0")).withColumn("_all", F.lit(0))
    heads = position(heads, ["_all"], ["_at", *group], F.col("_b"), "_n")
    return df.join(heads.select(*group, F.floor((F.col("_n") - 1) / size).alias(name)), group)


def insert_after(df: DataFrame, inserts: DataFrame, order: str, anchor: str, bucket_size: int, name: str = "ord") -> DataFrame:
    """Insert rows behind their anchor row and renumber 1..n.

    ``inserts`` has the columns of ``df`` without ``order`` plus ``after`` (an anchor value) and
    ``seq``: the order in which they are inserted (a later insert lands directly behind the anchor).
    """
    anchors = df.select(F.col(anchor).alias("after"), F.col(order).alias("_at"))
    placed = inserts.join(anchors, "after").withColumn("_sub", -F.col("seq")).drop("after", "seq")
    base = df.withColumn("_at", F.col(order)).withColumn("_sub", F.lit(-(1 << 40)).cast("long")).drop(order)
    merged = base.unionByName(placed.withColumn("_sub", F.col("_sub").cast("long"))).withColumn("_all", F.lit(0))
    return position(merged, ["_all"], ["_at", "_sub"], F.floor(F.col("_at") / bucket_size), name).drop("_at", "_sub", "_all")


def display_grid(df: DataFrame, group: Cols, order: Cols, bucket: Column) -> DataFrame:
    """Tone (index mod 3), row and column (two per row) and the filler flag of a lone last cell."""
    placed = position(df, group, order, bucket, "_n")
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    i = F.col("_n") - 1
    return (
        placed.join(sizes, group)
        .withColumn("tone", i % 3).withColumn("row", F.floor(i / 2)).withColumn("col", i % 2)
        .withColumn("filler", (F.col("_n") == F.col("_size")) & (i % 2 == 0))
        .drop("_n", "_size")
    )


def check_sequence(df: DataFrame, keys: Cols, order: Cols, bucket: Column, number: str, allow: DataFrame | None = None) -> DataFrame:
    """Rows whose printed number differs from their position, minus the allowed misprints."""
    wrong = position(df, keys, order, bucket, "expected").where(F.col("expected") != F.col(number))
    return wrong if allow is None else wrong.join(allow, [*keys, number], "left_anti")
