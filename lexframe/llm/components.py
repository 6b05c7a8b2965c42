"""Connected components: blocks of edges are contracted inside tasks, what is left by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexframe.llm.common import checkpointed

#: edges that are contracted at once: what a task holds
BLOCK_EDGES = 2**20


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges that are not the smallest of their component, and that smallest node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        # each label takes the least label that an edge of its members sees, then labels are followed to the end
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def contracted(edges: DataFrame, block: int = BLOCK_EDGES) -> tuple[DataFrame, bool]:
    """Edges (a, b), a > b, that connect the same nodes, and whether all of them were seen at once.

    Each task puts blocks of up to ``block`` edges together as they come, and keeps a spanning star of
    each component of a block; memory is bounded by the block.
    """
    edges = checkpointed(edges)
    parts = -(-edges.count() // block)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if held and sum(map(len, held)) + len(batch) > block:
                yield star(held)
                held = []
            held.append(batch)
        if held:
            yield star(held)

    def star(held: list[pd.DataFrame]) -> pd.DataFrame:
        together = pd.concat(held)
        a, b = contract(together["a"].to_numpy(), together["b"].to_numpy())
        return pd.DataFrame({"a": a, "b": b})

    return checkpointed(edges.coalesce(max(1, parts)).mapInPandas(shrink, "a long, b long")), parts <= 1


def components(edges: DataFrame, block: int = BLOCK_EDGES) -> DataFrame:
    """(node, component): for every node of ``edges`` (a, b, of type long) the smallest node it is connected with.

    Blocks of edges are first contracted inside tasks; a table of one block is then finished. On what
    is left each round hangs the larger neighbours of a node on its smallest one, then the smaller
    ones; it ends when every node hangs on its component's smallest node. Rounds grow with the
    logarithm of the nodes; a node of many edges is only ever aggregated and joined. Loops are
    passed over; edges with a null end as well.
    """
    stars, done = contracted(_oriented(edges.select("a", "b")), block)
    known = None
    while not done:
        count, mark = stars.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if (count, mark) == known:
            break
        known = (count, mark)
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _oriented(large)
        smallest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(smallest, F.col("a") == F.col("u"))
        stars = checkpointed(_oriented(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(stars.select(F.col("b"), F.col("b")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
