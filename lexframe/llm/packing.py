"""Best-fit packing planned over a histogram of lengths.

The plan never sees a document: it packs counts of equal lengths (at most ``capacity`` of them), so
its size is bounded by the capacity alone. Pieces then take the planned slots by joining on their
rank within their length. Ranks come from counts per (length, bucket of a hash) and a running number
inside each, so that a length that a third of all pieces share is spread over many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import checkpointed, named, packed_row, unpacked
from lexframe.llm.tokens import IdEncoder, kept_by_worker, ranks_of

CAPACITY = 2048
#: hash buckets that share out one length; at 10^10 equal pieces a task numbers some 2.5 million
BUCKETS = 4096
END = (0).to_bytes(4, "little")
PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"
SLOTS = "slot_length long, first long, pieces long, per_bin long, sequence long, place long"


def cut(ids: bytes, capacity: int) -> list[dict]:
    """Pieces of at most ``capacity`` ids; of a longer document only the first may be shorter."""
    n = len(ids) // 4
    head = n if n <= capacity else n % capacity or capacity
    ends = [head, *range(head + capacity, n + 1, capacity)]
    starts = [0, *ends[:-1]]
    return [
        {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])}
        for i, (a, b) in enumerate(zip(starts, ends, strict=True))
    ]


def pieces(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with piece, start, length and ids_crc32, a row per piece.

    A null or empty text is one piece, the closing id 0 alone. Columns named like a result are replaced.
    """
    local, ranks = spark.sparkContext.broadcast({}), spark.sparkContext.broadcast(ranks_of(path))  # bounded by the vocabulary

    @F.pandas_udf(PIECES)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = kept_by_worker(local, lambda: IdEncoder(path, ranks=ranks.value))
        for batch in batches:
            yield pd.Series([cut(encoder.encode(x) + END, capacity) for x in batch])

    # else the optimizer encodes a second time, to filter out rows without pieces before the generator
    encoded = encoded.asNondeterministic()
    results = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    kept = [c for c in docs.columns if c.lower() not in (*results, text.lower())]
    found = docs.select(packed_row(kept).alias("row"), encoded(F.coalesce(named(text), F.lit(""))).alias("pieces"))
    return found.select("row", F.inline("pieces")).select(*unpacked("row", kept), "piece", "start", "length", "ids_crc32")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit decreasing over counts: the slots of every length, and the number of sequences.

    A group is a number of equally filled sequences, numbered without gaps. For each length, from the
    longest, the pieces go to the fullest groups they fit in; what is left opens new sequences. A slot
    row (length, first, pieces, per_bin, sequence, place) says: the pieces of this length with ranks
    from ``first`` on go ``per_bin`` to a sequence, from ``sequence`` on, beginning at ``place``.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room -> groups (first sequence, sequences)
    free: list[int] = []  # the keys of room, ascending
    slots: list[tuple] = []
    opened = 0

    def add(left: int, first: int, number: int) -> None:
        if left and number:
            if left not in room:
                bisect.insort(free, left)
            room[left].append((first, number))

    def put(length: int, rank: int, count: int, left: int, first: int, number: int) -> int:
        """Fill a group with up to ``count`` pieces; the number placed."""
        per_bin = min(left // length, count)
        full = min(number, count // per_bin)
        placed = full * per_bin
        slots.append((length, rank, placed, per_bin, first, capacity - left))
        add(left - per_bin * length, first, full)
        rest = count - placed if full < number and count - placed < per_bin else 0
        if rest:
            slots.append((length, rank + placed, rest, rest, first + full, capacity - left))
            add(left - rest * length, first + full, 1)
            full += 1
        add(left, first + full, number - full)
        return placed + rest

    for length in sorted(histogram, reverse=True):
        count, rank = histogram[length], 0
        while count:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                left = free[at]
                first, number = room[left].pop()
                if not room[left]:
                    del room[left]
                    free.pop(at)
            else:
                left, first = capacity, opened
                number = -(-count // (capacity // length))
                opened += number
            placed = put(length, rank, count, left, first, number)
            rank, count = rank + placed, count - placed
    return slots, opened


def pack(spark: SparkSession, parts: DataFrame, key: list[str], capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """``parts`` (with length of 1 to ``capacity``) with sequence_id and offset.

    Equal rows are interchangeable; which of two equal lengths takes which slot follows a hash of
    ``key``. Columns named sequence_id or offset are replaced, other names may be any. Only the histogram and the plan, both bounded by ``capacity``, pass through the driver.
    An empty table gives an empty result.
    """
    kept = [c for c in parts.columns if c.lower() not in ("sequence_id", "offset")]
    dealt = checkpointed(
        parts.select(packed_row(kept).alias("row"), named("length").alias("length"), F.struct(*map(named, key)).alias("key"))
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    )
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows
    bases = checkpointed(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r[0]: r[1] for r in bases.groupBy("length").agg(F.sum("n")).collect()}
    slots, _ = plan(histogram, capacity)
    within = Window.partitionBy("length", "bucket").orderBy("key")
    numbered = dealt.withColumn("i", F.row_number().over(within) - 1).join(bases.select("length", "bucket", "before"), ["length", "bucket"])
    ranked = numbered.select("row", "length", (F.col("before") + F.col("i")).alias("rank"))
    table = F.broadcast(spark.createDataFrame(slots, SLOTS))  # bounded by the capacity, see plan
    on = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("pieces"))
    at = F.col("rank") - F.col("first")
    return ranked.join(table, on).select(
        *unpacked("row", kept),
        (F.col("sequence") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(at, F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
    )
