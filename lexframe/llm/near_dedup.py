"""Near-duplicates by bottom-k sketches from one hash function.

1. A document's set is its distinct five-word shingles (64-bit hashes); its sketch the K smallest.
   Equal sets form a class, represented by its smallest id; the rest works on classes.
2. Inverted lists of the sketch values. A pair at the threshold shares at least ``needed(n)`` sketch
   values (up to a chance far below 1e-6), so it shares one among the ``k - needed + 1`` rarest of
   each, and only those enter the lists; values of a single class enter none.
3. Lists of up to LIGHT classes give their pairs. Longer lists (copies by the hundred, passages) are
   first grouped to clusters, and a cluster is compared in blocks of bounded total size: overlaps are
   counted inside the task, and what leaves it is a spanning forest of the links, not the pairs.
4. Pairs whose union sketch does not reach the threshold (with the same slack) are put away, the
   others are verified on full sets: 100 * intersection >= 75 * union.
5. Connected components over the links name each document's component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import checkpointed, let, lower_ascii, named, words
from lexframe.llm.components import components

SHINGLE = 5
#: retained values of a sketch
K = 64
#: the threshold as a fraction
PART, WHOLE = 75, 100
#: standard deviations by which a sketch may fall short of its expected overlap
SLACK = 6.5
#: lists of more classes than this are compared in blocks
LIGHT = 32
#: shingles of two blocks that one task compares, on average
BLOCK_SHINGLES = 100_000


def shingles(text: Column) -> Column:
    """Sorted distinct shingle hashes; fewer than five words are one shingle, no words none."""

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)]))
        return F.sort_array(F.array_distinct(windows))

    def of_words(w: Column) -> Column:
        return (
            F.when(F.size(w) == 0, F.array().cast("array<long>"))
            .when(F.size(w) < SHINGLE, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes))
        )

    return let(words(lower_ascii(text)), of_words)


def needed(n: Column) -> Column:
    """The sketch values that a set of ``n`` shingles shares with any set at the threshold.

    The union has at most n * 100 / 75 shingles. If the sketches hold it whole, the overlap is exact;
    else the shared values among the K smallest of the union are hypergeometric.
    """
    union = F.floor(n * WHOLE / PART)
    share = PART / WHOLE
    sampled = F.floor(share * K - SLACK * F.sqrt(F.greatest(K * share * (1 - share) * (union - K) / F.greatest(union - 1, F.lit(1)), F.lit(0.0))))
    exact = F.ceil(n * PART / WHOLE)
    return F.when(union <= K, exact).when(n <= K, F.least(exact, sampled)).otherwise(sampled).cast("int")


def union_sketch_passes(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Whether the shared values among the K smallest of the union leave the threshold possible."""
    common = F.array_intersect(a, b)
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, K)
    return F.size(F.array_intersect(common, union)) >= F.least(needed(F.greatest(n_a, n_b)), needed(F.least(n_a, n_b)))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Shared values of every two sets; values of many sets by products of bit columns, others by pairs."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    for size in range(2, 16):
        starts = first[count == size]
        for i in range(size):
            for j in range(i):
                np.add.at(out, (owner[starts + i], owner[starts + j]), 1)
    out += out.T
    many = np.flatnonzero(count >= 16)
    for at in range(0, len(many), 2048):
        part = many[at : at + 2048]
        place = np.full(len(count), -1)
        place[part] = np.arange(len(part))
        column = place[value]
        bits = np.zeros((len(sets), len(part)), np.float32)
        bits[owner[column >= 0], column[column >= 0]] = 1
        out += bits @ bits.T
    return out


def _needed(n: np.ndarray) -> np.ndarray:
    union = np.floor(n * WHOLE / PART)
    share = PART / WHOLE
    sampled = np.floor(share * K - SLACK * np.sqrt(np.maximum(K * share * (1 - share) * (union - K) / np.maximum(union - 1, 1), 0)))
    exact = np.ceil(n * PART / WHOLE)
    return np.where(union <= K, exact, np.where(n <= K, np.minimum(exact, sampled), sampled))


def link_block(rows: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest (a, b) of the links between the sets of one block pair."""
    rows = rows.sort_values("cls").drop_duplicates("cls")
    reps, sets = rows["rep"].to_numpy(), [np.asarray(s, np.int64) for s in rows["shingles"]]
    sizes = np.array([len(s) for s in sets], np.float64)
    least = _needed(sizes)
    near = _overlaps([s[:K] for s in sets]) >= np.minimum(least[:, None], least[None, :])
    np.fill_diagonal(near, False)
    some = np.flatnonzero(near.any(1))
    if not len(some):
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    shared = _overlaps([sets[i] for i in some])
    union = sizes[some][:, None] + sizes[some][None, :] - shared
    links = near[np.ix_(some, some)] & (WHOLE * shared >= PART * union)
    label = np.arange(len(some))
    while True:
        least_near = np.where(links, label[None, :], len(some)).min(1)
        new = np.minimum(label, least_near)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(some)))
    return pd.DataFrame({"a": reps[some[own]], "b": reps[some[label[own]]]})


def links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as (id, n, d1, d2, rep), and the links (a, b) between representatives."""
    shingled = docs.select(named(key).cast("long").alias("id"), shingles(named(text)).alias("s"))
    rows = checkpointed(
        shingled.select("id", F.size("s").alias("n"), F.xxhash64("s").alias("d1"), F.xxhash64("s", F.lit(1)).alias("d2"), F.slice("s", 1, K).alias("sketch"))
    )
    real = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    digest = ["n", "d1", "d2"]
    # a class has a number of its own: neither half of the digest nor the smallest id names it alone
    classes = checkpointed(real.groupBy(*digest).agg(F.min("id").alias("rep")).withColumn("cls", F.monotonically_increasing_id()))
    members = real.select("id", *digest).join(classes, digest)
    # a row of the smallest id carries the sketch of its class
    sketches = real.join(classes.withColumnRenamed("rep", "id"), [*digest, "id"]).select("cls", F.col("id").alias("rep"), *digest, "sketch").dropDuplicates(["cls"])
    sketches = checkpointed(sketches)

    values = sketches.select("cls", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    shared = values.select("v").groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    entries = values.join(shared, "v")
    per_class = Window.partitionBy("cls")  # at most K rows
    rare = per_class.orderBy("df", "v")
    own = F.col("k") - F.count(F.lit(1)).over(per_class)  # values that no other class has come first
    entries = entries.withColumn("place", own + F.row_number().over(rare)).where(F.col("place") <= F.col("k") - needed(F.col("n")) + 1)
    entries = checkpointed(entries.select("v", "cls", "n"))
    lists = checkpointed(entries.groupBy("v").agg(F.count(F.lit(1)).alias("df"), F.min("cls").alias("leader")).where("df > 1"))

    light = entries.join(lists.where(F.col("df") <= LIGHT).select("v"), "v")
    left, right = light.toDF("v", "a", "n_a"), light.toDF("w", "b", "n_b")
    similar_size = (F.col("n_a") * WHOLE >= F.col("n_b") * PART) & (F.col("n_b") * WHOLE >= F.col("n_a") * PART)
    pairs = left.join(right, (F.col("v") == F.col("w")) & (F.col("a") < F.col("b")) & similar_size).select("a", "n_a", "b", "n_b").distinct()
    sketch = sketches.select("cls", "sketch")
    pairs = pairs.join(sketch.toDF("a", "s_a"), "a").join(sketch.toDF("b", "s_b"), "b")
    pairs = checkpointed(pairs.where(union_sketch_passes(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b"))).select("a", "b"))

    heavy = entries.join(lists.where(F.col("df") > LIGHT).select("v", "leader"), "v")
    clusters = components(heavy.select(F.col("cls").alias("a"), F.col("leader").alias("b")))
    clusters = checkpointed(clusters.select(F.col("node").alias("cls"), F.col("component").alias("cluster")))

    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(clusters.select("cls")).distinct()
    ids = sketches.join(wanted, "cls", "left_semi").select("cls", "rep", *digest)
    found = docs.select(named(key).cast("long").alias("rep"), named(text).alias("t")).join(ids, "rep")
    # cut here: as part of the join the comparison would hash every document before the shuffle
    sets = checkpointed(found.select("cls", "rep", *digest, shingles(F.col("t")).alias("shingles")))
    sets = sets.where((F.xxhash64("shingles") == F.col("d1")) & (F.xxhash64("shingles", F.lit(1)) == F.col("d2"))).drop("d1", "d2")

    full = sets.select("cls", "rep", "shingles")
    both = pairs.join(full.toDF("a", "rep_a", "f_a"), "a").join(full.toDF("b", "rep_b", "f_b"), "b")
    inter = F.size(F.array_intersect("f_a", "f_b"))
    verified = both.where(inter * WHOLE >= (F.size("f_a") + F.size("f_b") - inter) * PART).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    crowded = clusters.join(sets.select("cls", "n"), "cls").groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = sets.join(clusters, "cls").join(crowded, "cluster").withColumn("own", F.pmod(F.xxhash64("cls", "cluster"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "rep", "shingles")
    forest = dealt.groupBy("cluster", "i", "j").applyInPandas(lambda rows: link_block(rows), "a long, b long")

    # an id that stands on rows of several texts links their classes
    several = members.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b < top").select("id", "b")
    same_id = members.join(several, "id").select(F.col("rep").alias("a"), "b")
    return rows.join(classes, digest, "left").select("id", *digest, "rep"), verified.union(forest).union(same_id)


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Documents without words or text are linked with nothing and kept. A row without id has no
    component and is kept; it is no copy of any other. Rows of one id belong to one component. An
    empty table gives an empty result. Other columns are not read.
    """
    rows, edges = links(docs, key, text)
    joined = components(edges)
    linked = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    alone = rows.where((F.col("n") == 0) | F.col("id").isNull())
    linked = linked.join(joined, linked["rep"] == joined["node"], "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
    out = linked.union(alone.select("id", "n", F.col("id").alias("component")))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * o >= 75 * (x.n + y.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.least, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""
