"""Vector code compression: product codes whose codebooks are fitted over Hilbert-sorted flat blocks.

1. Vectors become whole numbers and are cut into equal parts. The parts of each position are sorted
   along a Hilbert curve and packed into flat blocks of neighbours; a block stores the box (least and
   largest components) and the sum of its parts.
2. In every round the distances from a block's box to the codebook's entries give a shortlist: an
   entry whose least distance to the box exceeds another's largest one is nearest to no part of it.
   A block with one entry on its list adds its stored sum as a whole; in the others an exact
   whole-number kernel compares the parts with the shortlist only.
3. Sums and counts add up per entry on Spark; the codebooks (``entries`` entries of a vector's length)
   are all that passes through the driver and is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import checkpointed, named

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: parts of a block
BLOCK_ROWS = 512
#: bits of a curve index
CURVE_BITS = 62
#: whole numbers are exact up to here in double precision, and sums of squares up to LONG in 64 bits
EXACT, LONG = 2**53, 2**63 - 1
#: a distance larger than this is held here, so that the sum over the parts is a long
FAR = 2**60
#: sums are split at this bit for adding up, so that no sum overflows
SPLIT = 31
KEYED = "dim int, part int, curve long, uid long, cells binary"
BLOCKS = "dim int, part int, uids binary, cells binary, lo binary, hi binary, total_high array<long>, total_low array<long>"
SUMS = "dim int, part int, entry int, n long, high array<long>, low array<long>"
CODES = "uid long, part int, code int, far long"
Books = dict[tuple[int, int], np.ndarray]


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve index of each row of whole numbers below 2**bits (columns times bits up to 62)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(n):
            high = (x[i] >> level) & 1
            swap = np.where(high == 1, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high == 1, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    index = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for column in x:
            index = (index << 1) | (((column ^ turn) >> level) & 1)
    return index


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, matrix) of a batch whose column ``v`` holds lists of different lengths."""
    lists = batch.column("v")
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat, lengths = lists.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, flat[ends[rows][:, None] + np.arange(dim)[None, :]]


def quantise(vectors: DataFrame, key: str, vector: str, label: str, scale: int, parts: int) -> DataFrame:
    """(uid, id, label, v, dim): floor(scale * x) of every vector of finite components that parts evenly."""
    x = named(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    rows = vectors.where(x.isNotNull() & finite & (F.size(x) > 0) & (F.size(x) % parts == 0))
    return rows.select(F.monotonically_increasing_id().alias("uid"), named(key).cast("long").alias("id"), named(label).alias("label"), v.alias("v"), F.size(x).alias("dim"))


def extents(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and largest value of every component, by the number of components."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, _, m in _by_dim(batch):
                lo, hi = seen.get(dim, (m[0], m[0]))
                seen[dim] = np.minimum(lo, m.min(0)), np.maximum(hi, m.max(0))
        for dim, (lo, hi) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim), pa.int32()), pa.array(lo), pa.array(hi)], ["dim", "j", "lo", "hi"])

    found = rows.select("v").mapInArrow(ends, "dim int, j int, lo long, hi long").groupBy("dim", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in found:  # a row per component
        lo, hi = out.setdefault(r.dim, (np.zeros(r.dim, np.int64), np.zeros(r.dim, np.int64)))
        lo[r.j], hi[r.j] = r.lo, r.hi
    return out


def _width(ends: tuple[np.ndarray, np.ndarray]) -> str:
    top = max(abs(int(ends[0].min())), abs(int(ends[1].max())))
    return "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<i8"


def blocks(rows: DataFrame, ends: dict[int, tuple[np.ndarray, np.ndarray]], parts: int) -> DataFrame:
    """Flat blocks of the parts of each position in the order of the curve."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column("uid").to_numpy()
            for dim, at, m in _by_dim(batch):
                lo, hi = ends[dim]
                size, width = dim // parts, _width(ends[dim])
                axes = min(size, CURVE_BITS)
                bits = min(16, CURVE_BITS // axes)
                reach = np.maximum(hi.astype(np.float64) - lo, 1)
                cells = np.minimum((m - lo.astype(np.float64)) / reach * 2**bits, 2**bits - 1).astype(np.int64)
                for part in range(parts):
                    own = np.ascontiguousarray(m[:, part * size : (part + 1) * size].astype(width))
                    curve = curve_index(cells[:, part * size : part * size + axes], bits)
                    step = own.shape[1] * own.itemsize
                    offsets = pa.py_buffer(np.arange(0, (len(own) + 1) * step, step, dtype=np.int32).tobytes())
                    packed = pa.Array.from_buffers(pa.binary(), len(own), [None, offsets, pa.py_buffer(own.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), dim), pa.int32()), pa.array(np.full(len(own), part), pa.int32()), pa.array(curve), pa.array(uids[at]), packed],
                        ["dim", "part", "curve", "uid", "cells"],
                    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, positions = batch.column("dim").to_numpy(), batch.column("part").to_numpy()
            uids, cells = batch.column("uid").to_numpy().astype("<i8"), batch.column("cells")
            turns = np.flatnonzero((np.diff(dims) != 0) | (np.diff(positions) != 0)) + 1
            out: list[tuple] = []
            for first, stop in zip([0, *turns], [*turns, len(dims)], strict=True):
                for start in range(first, stop, BLOCK_ROWS):
                    upto = min(stop, start + BLOCK_ROWS)
                    dim = int(dims[start])
                    raw = b"".join(cells[start:upto].to_pylist())
                    m = np.frombuffer(raw, _width(ends[dim])).reshape(upto - start, -1).astype(np.int64)
                    high, low = _split(_sum(m))
                    out.append((dim, int(positions[start]), uids[start:upto].tobytes(), raw, m.min(0).astype("<i8").tobytes(), m.max(0).astype("<i8").tobytes(), high, low))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), *(pa.binary(),) * 4, *(pa.list_(pa.int64()),) * 2), strict=True)],
                    ["dim", "part", "uids", "cells", "lo", "hi", "total_high", "total_low"],
                )

    order = ("dim", "part", "curve", "uid")
    ranged = rows.select("uid", "v").mapInArrow(keyed, KEYED).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(packed, BLOCKS)


def _sum(m: np.ndarray) -> np.ndarray:
    """Sums of the columns, as unbounded whole numbers where 64 bits might not hold them."""
    top = max((abs(int(m.min())), abs(int(m.max())))) if m.size else 0
    return m.sum(0) if top * max(1, len(m)) <= LONG else m.astype(object).sum(0)


def _split(sums: np.ndarray) -> tuple[list[int], list[int]]:
    return [int(s) >> SPLIT for s in sums], [int(s) & ((1 << SPLIT) - 1) for s in sums]


def shortlist(book: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The entries that may be nearest to a part inside the box, ascending."""
    book, lo, hi = (_roomy(a, book, lo, hi) for a in (book, lo, hi))
    outside = np.maximum(np.maximum(lo[None, :] - book, book - hi[None, :]), 0)
    across = np.maximum(abs(book - lo[None, :]), abs(hi[None, :] - book))
    return np.flatnonzero((outside * outside).sum(1) <= (across * across).sum(1).min())


def _roomy(wanted: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """``wanted`` in a type in which squared distances between any of the arrays are exact."""
    top = max(max(abs(int(a.min())), abs(int(a.max()))) for a in others if a.size)
    return wanted if others[0].shape[-1] * (2 * top) ** 2 <= LONG else wanted.astype(object)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all parts to all entries, exactly."""
    top = max(abs(int(parts.min())), abs(int(parts.max())), abs(int(entries.min())), abs(int(entries.max())))
    if 4 * parts.shape[1] * top * top < EXACT:  # whole numbers of this size are exact in doubles
        a, b = parts.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    a, b = _roomy(parts, parts, entries), _roomy(entries, parts, entries)
    out = np.empty((len(a), len(b)), a.dtype)
    for i, entry in enumerate(b):
        out[:, i] = ((a - entry[None, :]) ** 2).sum(1)
    return out


def _cells(row: dict, ends: dict, parts: int) -> np.ndarray:
    return np.frombuffer(row["cells"], _width(ends[row["dim"]])).reshape(-1, row["dim"] // parts).astype(np.int64)


def _listed(row: dict, book: np.ndarray) -> np.ndarray:
    return shortlist(book, np.frombuffer(row["lo"], "<i8"), np.frombuffer(row["hi"], "<i8"))


def refine(flat: DataFrame, books: Books, ends: dict, parts: int) -> Books:
    """One round: every entry becomes the floor of the mean of the parts that are nearest to it."""
    sent = flat.sparkSession.sparkContext.broadcast(books)  # entries times components

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                place = (row["dim"], row["part"])
                book = sent.value[place]
                near = _listed(row, book)
                if len(near) == 1:
                    whole = np.array([(h << SPLIT) + low for h, low in zip(row["total_high"], row["total_low"], strict=True)], object)
                    found = [(int(near[0]), len(row["uids"]) // 8, whole)]
                else:
                    m = _cells(row, ends, parts)
                    nearest = near[np.argmin(distances(m, book[near]), axis=1)]
                    found = [(int(e), int((nearest == e).sum()), _sum(m[nearest == e])) for e in np.unique(nearest)]
                for entry, n, total in found:
                    old = totals.get((*place, entry))
                    totals[(*place, entry)] = [n, total.astype(object)] if old is None else [old[0] + n, old[1] + total]
        if totals:
            split = [_split(total) for _, total in totals.values()]
            keys = np.array(list(totals), np.int64)
            columns = [pa.array(keys[:, i], pa.int32()) for i in range(3)]
            columns += [pa.array([n for n, _ in totals.values()], pa.int64()), *(pa.array([s[i] for s in split], pa.list_(pa.int64())) for i in range(2))]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "part", "entry", "n", "high", "low"])

    sums = flat.mapInArrow(summed, SUMS)
    by_place = sums.select("dim", "part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("j", "x"))
    rows = by_place.groupBy("dim", "part", "entry", "j").agg(F.sum("n").alias("n"), F.sum("x.high").alias("high"), F.sum("x.low").alias("low")).collect()
    sent.destroy()
    out = {place: book.copy() for place, book in books.items()}
    for r in rows:  # at most a row per component of the codebooks
        out[(r.dim, r.part)][r.entry, r.j] = ((r.high << SPLIT) + r.low) // r.n
    return out


def assign(flat: DataFrame, books: Books, ends: dict, parts: int) -> DataFrame:
    """(uid, part, code, far): the nearest entry of every part and its squared distance."""
    sent = flat.sparkSession.sparkContext.broadcast(books)  # entries times components

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                book = sent.value[(row["dim"], row["part"])]
                near = _listed(row, book)
                far = distances(_cells(row, ends, parts), book[near])
                best = np.argmin(far, axis=1)
                least = np.minimum(far[np.arange(len(far)), best], FAR).astype(np.int64)
                part = np.full(len(far), row["part"])
                columns = [np.frombuffer(row["uids"], "<i8"), part.astype(np.int32), near[best].astype(np.int32), least]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "part", "code", "far"])

    return flat.mapInArrow(coded, CODES)


def first_books(rows: DataFrame, entries: int, parts: int) -> Books:
    """The parts of the vectors of the smallest ids (then by components; no id last)."""
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(*order))  # only ``entries`` rows of a task reach the shuffle
    chosen = rows.select("dim", "id", "v", rank.alias("at")).where(F.col("at") <= entries).collect()
    by_dim: dict[int, list] = {}
    for r in sorted(chosen, key=lambda r: r.at):
        by_dim.setdefault(r.dim, []).append(r.v)
    return {(dim, p): np.array(vs, np.int64)[:, p * (dim // parts) : (p + 1) * (dim // parts)] for dim, vs in by_dim.items() for p in range(parts)}


def digest(books: Books, dim: int, parts: int) -> str:
    numbers = ",".join(str(int(x)) for p in range(parts) for x in books[(dim, p)].ravel())
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Books]:
    """(vec_id, code, error, label, label_error, codebooks_sha256) per vector, and the codebooks.

    Vectors that are null, hold a null or non-finite component, or do not part evenly (empty ones
    among them) take no part. Vectors of different lengths have codebooks of their own. Rows without
    an id come last in the order of ids; repeated rows are rows of their own. Null labels count as
    one label. An empty table gives an empty result. Components beyond a long are held at its ends,
    and so is a distance beyond 2**60 there. Other columns are not read.
    """
    rows = checkpointed(quantise(vectors, key, vector, label, scale, parts))
    ends = extents(rows)
    flat = checkpointed(blocks(rows, ends, parts))
    books = first_books(rows, entries, parts)
    for _ in range(rounds):
        books = refine(flat, books, ends, parts)
    coded = assign(flat, books, ends, parts)
    hexes = [F.max(F.when(F.col("part") == p, F.lpad(F.lower(F.hex("code")), 2, "0"))) for p in range(parts)]
    codes = coded.groupBy("uid").agg(F.concat(*hexes).alias("code"), F.sum("far").alias("error"))
    found = checkpointed(rows.select("uid", "id", "label", "dim").join(codes, "uid"))
    # a label may hold any share of the rows: totals are small, and each copy of one serves a share of its rows
    totals = found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("sum"))
    salts = 64
    totals = totals.select(F.col("label").alias("__label"), F.least("sum", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    dealt = found.withColumn("salt", F.pmod("uid", F.lit(salts)).cast("int"))
    whole = dealt.join(totals, dealt["label"].eqNullSafe(totals["__label"]) & (dealt["salt"] == totals["__salt"]))
    hashes = spark.createDataFrame([(d, digest(books, d, parts)) for d in ends], "__dim int, codebooks_sha256 string")
    out = whole.join(F.broadcast(hashes), F.col("dim") == F.col("__dim"))  # a row per number of components
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label", "label_error", "codebooks_sha256"), books


def _oracle() -> str:
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(
            f"""
b{i} AS MATERIALIZED (
  SELECT uid, part, any_value(x) AS x, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT p.uid, p.part, p.x, c.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda k: (p.x[k] - c.x[k]) * (p.x[k] - c.x[k])))::BIGINT AS d
        FROM p JOIN c{i} c ON c.part = p.part) GROUP BY uid, part)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""
u{i} AS (SELECT part, entry, j, floor_div(sum(v), count(*)) AS v FROM (SELECT part, entry, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS v FROM b{i}) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT part, entry, list(v ORDER BY j) AS x FROM u{i} GROUP BY part, entry) n USING (part, entry))"""
            )
    joined = ",".join(steps).replace("floor_div(sum(v), count(*))", "((sum(v) - (((sum(v) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS uid, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS MATERIALIZED (
  SELECT uid, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS x FROM v, range({PARTS}) r(part)),
c0 AS MATERIALIZED (SELECT part, uid AS entry, x FROM p WHERE uid < {ENTRIES}),{joined},
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{ROUNDS}),
f AS (SELECT uid, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM b{ROUNDS} GROUP BY uid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM f JOIN v USING (uid), h"""


ORACLE = _oracle()
