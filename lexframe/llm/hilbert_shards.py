"""Sharding along a Hilbert curve over document metadata.

Each dimension is quantised at its own quantiles, the cells are ordered along a Hilbert curve, and the
ordered documents are cut into runs of equal number. A shard then covers a compact region of all
dimensions at once, so filters on any of them prune files by their minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.llm.common import checkpointed, named, packed_row, unpacked

BITS = 5
SHARDS = 8
#: hash buckets over which the documents of one cell are dealt for their running numbers
BUCKETS = 1024
DIMENSIONS = ("source", "lang", "size")


def ordered(column: Column) -> Column:
    """The whole string with its order kept; null comes first."""
    return F.coalesce(F.concat(F.lit("1"), column), F.lit("0"))


def string_limits(rows: DataFrame, axis: str, shares: list[float]) -> list[str]:
    """The least value of ``axis`` up to which each share of the rows lies; none for an empty table.

    Distinct values are range-sorted with their counts; a range adds the counts of the ranges before it.
    """
    counts = rows.groupBy(axis).agg(F.count(F.lit(1)).alias("__n"))
    ranged = checkpointed(counts.repartitionByRange(axis).withColumn("__part", F.spark_partition_id()))
    parts = ranged.groupBy("__part").agg(F.sum("__n").alias("__m"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    before = parts.withColumn("__before", F.coalesce(F.sum("__m").over(earlier), F.lit(0))).drop("__m")
    within = Window.partitionBy("__part").orderBy(axis).rowsBetween(Window.unboundedPreceding, 0)
    upto = ranged.withColumn("__upto", F.sum("__n").over(within)).join(F.broadcast(before), "__part")
    reached = F.col("__before") + F.col("__upto")
    total = parts.agg(F.coalesce(F.sum("__m"), F.lit(0))).first()[0]
    return [v for v in upto.agg(*[F.min(F.when(reached >= share * total, F.col(axis))).alias(f"v{i}") for i, share in enumerate(shares)]).first() if v is not None]


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index along the Hilbert curve of a cell with coordinates of ``bits`` bits (at most 62 in all)."""
    n = len(axes)
    if not 1 < n * bits <= 62:
        raise ValueError("2 to 62 bits in all")
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def turned(s: Column, step: Column) -> Column:
        low = step["q"] - 1
        own = F.get(s, step["i"])
        swap = F.get(s, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            s,
            lambda x, j: F.when(own.bitwiseAND(step["q"]) != 0, F.when(j == 0, x.bitwiseXOR(low)).otherwise(x))
            .when((j == 0) | (j == step["i"]), x.bitwiseXOR(swap))
            .otherwise(x),
        )

    start = F.array(*[a.cast("int") for a in axes])
    axis = F.aggregate(steps, start, turned) if bits > 1 else start
    none = F.lit(0)
    gray = lambda s: F.transform(s, lambda x, j: F.aggregate(F.slice(s, F.lit(1), j + 1), none, lambda a, b: a.bitwiseXOR(b)))
    powers = F.array(*[F.lit(1 << b) for b in range(bits)])
    flips = lambda s: F.aggregate(powers, none, lambda a, q: F.when(F.get(s, F.lit(n - 1)).bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a))
    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])

    def woven(s: Column) -> Column:
        t = flips(s)
        return F.aggregate(
            places, F.lit(0).cast("long"), lambda a, p: a * 2 + F.when(F.get(s, p["i"]).bitwiseXOR(t).bitwiseAND(p["q"]) != 0, 1).otherwise(0)
        )

    return F.transform(F.array(axis), lambda s: F.transform(F.array(gray(s)), woven)[0])[0]


def quantised(column: Column, limits: list) -> Column:
    """How many of ``limits`` lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, limits)), lambda x: x < column)) if limits else F.lit(0)


def shards(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, number: int = SHARDS, bits: int = BITS, buckets: int = BUCKETS, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` with size, text_crc32, cell, law, shard, slot and grown_shard.

    ``dimensions`` are columns of ``docs`` or ``size`` (UTF-8 bytes of the text, null none, plus 1).
    The law is ``rows``: shards differ by one document at most, the first ones are the longer;
    ``slot`` numbers each shard without gaps. Null dimensions sort first, null text has the checksum
    of the empty text. Repeated rows are placed one by one. An empty table stays empty. Columns named
    like a result are replaced; ``text`` is returned only with ``keep_text``.
    """
    results = ("size", "text_crc32", "cell", "law", "shard", "slot", "grown_shard")
    kept = [c for c in docs.columns if c.lower() not in results and (keep_text or c.lower() != text.lower())]
    whole = F.coalesce(named(text), F.lit(""))
    kinds = dict(docs.dtypes)
    own = {d: (F.octet_length(whole) + 1 if d == "size" else ordered(named(d)) if kinds[d] == "string" else F.coalesce(named(d).cast("double"), F.lit(float("-inf")))) for d in dimensions}
    axes = [f"__axis{i}" for i in range(len(dimensions))]
    measured = checkpointed(
        docs.select(
            packed_row(kept).alias("__row"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(named(key), whole), 1).alias("__order"),
            named(key).alias("__key"),
            *[own[d].alias(a) for d, a in zip(dimensions, axes, strict=True)],
        )
    )
    shares = [i / 2**bits for i in range(1, 2**bits)]
    strings = [a for d, a in zip(dimensions, axes, strict=True) if d != "size" and kinds[d] == "string"]
    limits = {a: string_limits(measured, a, shares) for a in strings}
    numbers = [a for a in axes if a not in limits]
    if numbers:
        limits |= measured.agg(*[F.percentile_approx(a, shares, 10_000).alias(a) for a in numbers]).first().asDict()
    cells = measured.withColumn("cell", hilbert_index([quantised(F.col(a), limits[a] or []) for a in axes], bits))
    cells = cells.drop(*axes).withColumn("__bucket", F.shiftrightunsigned("__order", 63 - (buckets - 1).bit_length()))

    counts = cells.groupBy("cell", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("cell").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = checkpointed(counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))))
    along = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most 2^(bits * dimensions) rows
    by_cell = by_bucket.groupBy("cell").agg(F.sum("__n").alias("__m")).withColumn("__base", F.coalesce(F.sum("__m").over(along), F.lit(0)))
    bases = by_bucket.join(by_cell, "cell").select("cell", "__bucket", (F.col("__base") + F.col("__before")).alias("__first"))
    total = by_bucket.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]

    within = Window.partitionBy("cell", "__bucket").orderBy("__order", "__key", "size", "text_crc32")
    rank = F.col("__first") + F.row_number().over(within) - 1
    placed = cells.join(bases, ["cell", "__bucket"]).withColumn("__rank", rank)
    least, longer = divmod(total, number)
    bound = longer * (least + 1)
    at, short = F.col("__rank"), max(least, 1)
    shard = F.when(at < bound, F.floor(at / (least + 1))).otherwise(longer + F.floor((at - bound) / short)).cast("int")
    slot = F.when(at < bound, F.pmod(at, F.lit(least + 1))).otherwise(F.pmod(at - bound, F.lit(short))).cast("long")
    return placed.select(
        *unpacked("__row", kept), "size", "text_crc32", "cell", F.lit("rows").alias("law"),
        shard.alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(placed: DataFrame, folder: str) -> None:
    """A folder per shard; inside and across its files the documents stand in curve order."""
    ranged = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.mode("errorifexists").partitionBy("shard").parquet(folder)
