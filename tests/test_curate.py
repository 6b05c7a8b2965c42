"""Edits with provenance and moved bases, fingerprint trees, ordered diffs, ranged positions."""

import random

from pyspark.sql import functions as F

from lexframe.operators import curate as C, order as O

RECORD = "struct<gloss:string,src:string>"


def rows(spark, data):
    return spark.createDataFrame(data, f"key long, record {RECORD}")


def tag(spark, gloss, src):
    return rows(spark, [(0, (gloss, src))]).select(C.etag(F.col("record"))).first()[0]


def test_apply_edits_keeps_provenance_and_refuses_moved(spark):
    base = rows(spark, [(1, ("a", "gen")), (2, ("b", None)), (3, ("c", "gen"))])
    first, second = tag(spark, "a", "gen"), tag(spark, "b", None)
    edits = spark.createDataFrame([
        (1, 1, 10, "one", first, ("a", "hand"), True),  # the gloss stays, so the flag of the base does: nothing changes
        (1, 2, 11, " two ", first, ("x", "gen"), True),  # the gloss changes: no flag
        (1, 3, 12, "two", tag(spark, "x", None), ("a", None), True),  # back to the gloss of the base: flagged again
        (2, 4, 13, "r", second, ("y", "gen"), True), (2, 5, 14, "", tag(spark, "y", None), ("z", None), True),
        (3, 6, 15, "r", tag(spark, "c", "gen"), ("d", None), True), (4, 7, 16, "r", "0", ("e", None), True),
    ], f"key long, ord long, at long, reason string, expected_etag string, record {RECORD}, valid boolean")
    moved = spark.createDataFrame([(3,)], "key long")
    overlay, log = C.apply_edits(base, edits, ("src", "gloss", "gen"), moved)
    assert {r.ord: r.status for r in log.collect()} == {1: "unchanged", 2: "saved", 3: "saved", 4: "saved", 5: "reason", 6: "moved", 7: "unknown"}
    out = {r.key: r for r in overlay.collect()}
    assert {k: (r.human.gloss, r.human.src, r.revision, r.updated_at) for k, r in out.items()} == {1: ("a", "gen", 2, 12), 2: ("y", None, 1, 13)}
    assert out[1].baseline_etag == first
    assert {(r.key, r.reason, r.ord) for r in C.edit_reasons(log).collect()} == {(1, "two", 2), (2, "r", 4)}


def test_moved_keys(spark):
    rng = random.Random(1)
    old = {k: (rng.choice("abc"), rng.choice(["x", None])) for k in range(300)}
    new = {k: v for k, v in old.items() if k % 50} | {1000: ("n", None)}
    new[7] = ("changed", None)
    before, after = (rows(spark, list(v.items())) for v in (old, new))
    got = {r.key: r.change for r in C.moved_keys(before, after, buckets=16).collect()}
    assert got == {**{k: "removed" for k in range(0, 300, 50)}, 7: "changed", 1000: "added"}
    same = C.fingerprint_tree(before.repartition(3), buckets=16)
    assert C.moved_buckets(C.fingerprint_tree(before, buckets=16), same).count() == 0
    roots = [tuple(C.fingerprint_root(C.fingerprint_tree(df, buckets=b)).first()) for df, b in ((before, 16), (before, 5), (after, 16))]
    assert roots[0] == roots[1] != roots[2] and roots[0][0] == 300
    assert tuple(C.fingerprint_root(C.fingerprint_tree(before.limit(0))).first()) == (0, 0, 0)


def test_diff_has_an_order_and_sees_empty_containers(spark):
    kind = "key int, record struct<a:string,l:array<int>,m:map<string,int>,n:struct<x:int>>"
    before = spark.createDataFrame([(1, ("p", [1, 2], {"k": 1}, (5,))), (2, ("p", [], {}, None))], kind)
    after = spark.createDataFrame([(1, ("q", [], {"k": 1, "z": 2}, (5,))), (2, ("p", [7], {}, (1,)))], kind)
    got = {k: [tuple(r)[1:4] for r in C.diff_records(before, after).where(f"key = {k}").orderBy("order").collect()] for k in (1, 2)}
    assert got[1] == [("a", "p", "q"), ("l[0]", "1", None), ("l[1]", "2", None), ("l", None, "[]"), ("m.z", None, "2")]
    assert got[2] == [("l", "[]", None), ("l[0]", None, "7"), ("n.x", None, "1")]


def test_ranged_positions(spark):
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.7 else str(rng.randrange(5)), rng.randrange(3), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v int, id int")
    got = {r.id: r.pos for r in O.ranged_position(df.repartition(7), ["k"], ["v", "id"]).collect()}
    wanted = {}
    for k in {r[0] for r in data}:
        wanted |= {row[2]: i + 1 for i, row in enumerate(sorted((r for r in data if r[0] == k), key=lambda r: r[1:]))}
    assert got == wanted
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little would become one range
    try:
        sizes = O.ranged(df, ["k"], ["v", "id"]).groupBy("_range").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 700
