"""Exact inner-product search over vectors sorted by length.

Vectors are quantised to integers, sorted by descending length and packed into blocks. A rotation by
the singular vectors of all data gathers most of each length in the first coordinates. A query block
walks the blocks of a stripe from the longest vectors on: by Cauchy-Schwarz a score is at most the
partial sum over the first coordinates plus the product of the residual lengths, so a vector whose
bound lies below the query's current k-th score is passed over, and the walk ends where even the
product of whole lengths does. Survivors are scored with integers, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import checkpointed

SCALE = 256
QUERY_ROWS = 256
BLOCK_ROWS = 1024
#: blocks that one task walks; with the rows of a block this bounds a task's memory
STRIPE_BLOCKS = 16
BLOCKS = "dim int, block long, longest double, ids binary, uids binary, vectors binary"
FOUND = "uid long, query_id long, vec_id long, score long"
#: products of whole numbers up to here are exact in double precision
EXACT = 2.0**53


def quantise(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(uid, id, v, dim, norm): floor(scale * x) of every vector with finite components and a key."""
    v = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "id", "v", F.size("v").alias("dim"), norm.alias("norm"))


def _matrix(cells: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(cells, "<i8").reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)


def _pack(rows: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, same in batch.groupby("dim", sort=False):
                for at in range(0, len(same), rows):
                    part = same.iloc[at : at + rows]
                    vectors = np.array(part["v"].tolist(), "<i8").reshape(len(part), dim)
                    yield pd.DataFrame([{
                        "dim": dim, "block": int(part["uid"].iloc[0]), "longest": float(part["norm"].max()),
                        "ids": part["id"].to_numpy("<i8").tobytes(), "uids": part["uid"].to_numpy("<i8").tobytes(), "vectors": vectors.tobytes(),
                    }])

    return pack


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all vectors of one length, from sums of products added up per task."""

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            m = np.array(batch["v"].tolist(), np.float64).reshape(-1, dim)
            total += m.T @ m
        yield pd.DataFrame({"i": np.repeat(np.arange(dim), dim), "j": np.tile(np.arange(dim), dim), "x": total.ravel()})

    sums = rows.where(F.col("dim") == dim).select("v").mapInPandas(products, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x")).collect()
    gram = np.zeros((dim, dim))
    for i, j, x in sums:
        gram[i, j] = x
    values, columns = np.linalg.eigh((gram + gram.T) / 2)
    return columns[:, np.argsort(-values)]


def _scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole-number inner products; sums beyond a long are held at its ends."""
    top = float(np.abs(query).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(query.shape[-1], 1)
    if top < EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(query, v, strict=True)) for v in vectors]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], np.int64)


def walk(queries: pd.DataFrame, blocks: pd.DataFrame, k: int, turns: dict[int, np.ndarray]) -> pd.DataFrame:
    """The k best of the stripe for each query of the block."""
    if queries.empty or blocks.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("uid", "query_id", "vec_id", "score")})
    dim = int(queries["dim"].iloc[0])
    turn = turns.get(dim, np.eye(dim))
    lead = max(1, dim // 4) if dim else 0
    ids, uids = np.frombuffer(queries["ids"].iloc[0], "<i8"), np.frombuffer(queries["uids"].iloc[0], "<i8")
    whole = _matrix(queries["vectors"].iloc[0], dim) if dim else np.zeros((len(ids), 0), np.int64)
    turned = whole.astype(np.float64) @ turn
    norms = np.sqrt((turned**2).sum(1))
    rest = np.sqrt(np.maximum((turned[:, lead:] ** 2).sum(1), 0))
    best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, vec_id), ascending
    least = np.full(len(ids), -np.inf)
    for block in blocks.sort_values("longest", ascending=False, kind="stable").itertuples():
        # a slack far above the rounding of the rotated sums keeps ties and near ties in
        slack = 1e-9 * norms * block.longest + 1e-6
        if (norms * block.longest + slack < least).all():
            break
        own, own_uids = np.frombuffer(block.ids, "<i8"), np.frombuffer(block.uids, "<i8")
        vectors = _matrix(block.vectors, dim) if dim else np.zeros((len(own), 0), np.int64)
        other = vectors.astype(np.float64) @ turn
        bound = turned[:, :lead] @ other[:, :lead].T + rest[:, None] * np.sqrt(np.maximum((other[:, lead:] ** 2).sum(1), 0))[None, :]
        for q in range(len(ids)):
            near = np.flatnonzero((bound[q] + slack[q] >= least[q]) & (own_uids != uids[q]))
            if not len(near):
                continue
            scores = _scores(whole[q], vectors[near])
            order = np.lexsort((own[near], -scores))[:k]
            best[q] = sorted(best[q] + [(-int(scores[i]), int(own[near[i]])) for i in order])[:k]
            if len(best[q]) == k:
                least[q] = -best[q][-1][0]
    rows = [(int(uids[q]), int(ids[q]), v, -s) for q, found in enumerate(best) for s, v in found]
    return pd.DataFrame(rows, columns=["uid", "query_id", "vec_id", "score"])


def search(spark: SparkSession, vectors: DataFrame, is_query, k: int = 5, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of every other row for each row where ``is_query``.

    ``is_query`` is a condition on the column ``id``. Ties go to the smaller vec_id. Vectors that are
    null, hold a null or a non-finite component, or have no key take no part; vectors of different
    numbers of components are not compared. Repeated rows are rows of their own: one finds the other.
    An empty table or query set gives an empty result. Scores beyond a long are held at its ends.
    """
    rows = checkpointed(quantise(vectors, key, vector, scale))
    dims = [r.dim for r in rows.select("dim").distinct().collect()]
    turns = {d: rotation(rows, d) for d in dims if d}
    ranged = rows.repartitionByRange(F.col("dim"), F.col("norm").desc(), "uid").sortWithinPartitions("dim", F.col("norm").desc(), "uid")
    blocks = checkpointed(ranged.mapInPandas(_pack(BLOCK_ROWS), BLOCKS))
    asked = rows.where(is_query).repartitionByRange("dim", "uid").sortWithinPartitions("dim", "uid")
    queries = checkpointed(asked.mapInPandas(_pack(QUERY_ROWS), BLOCKS))
    # stripes take every n-th block of the order by length, so that each starts with long vectors
    per_dim = Window.partitionBy("dim")
    by_length = per_dim.orderBy(F.col("longest").desc(), "block")  # a row per block
    heads = blocks.select("dim", "block", "longest").withColumn("__i", F.row_number().over(by_length) - 1)
    heads = heads.withColumn("stripes", F.ceil(F.count(F.lit(1)).over(per_dim) / STRIPE_BLOCKS).cast("long"))
    striped = blocks.join(heads.select("dim", "block", "stripes", F.pmod("__i", "stripes").alias("stripe")), ["dim", "block"])
    per_stripe = heads.groupBy("dim").agg(F.max("stripes").alias("stripes"))
    asks = queries.select("dim", F.col("block").alias("ask"))
    # a query block meets every stripe: the stated query set against all rows, block by block
    left = queries.withColumnRenamed("block", "ask").join(per_stripe, "dim").withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)))
    right = striped.drop("stripes").join(asks, "dim")
    lists = left.groupBy("dim", "ask", "stripe").cogroup(right.groupBy("dim", "ask", "stripe")).applyInPandas(
        lambda q, b: walk(q, b, k, turns), FOUND
    )
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 5"""
