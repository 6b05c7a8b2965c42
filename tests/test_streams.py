import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lexframe.operators import curate as C
from lexframe.streaming.edits import apply_edit_stream
from lexframe.streaming.responses import ledger_stream

EDITS = [
    # key, ord, reason, expected, new, valid -> status
    ("a", 1, "fix", "0", "0", True, "unchanged"), ("a", 2, "fix", "0", "1", True, "saved"), ("a", 3, "fix", "0", "2", True, "conflict"),
    ("a", 4, " ", "1", "2", True, "reason"), ("a", 5, "x", "1", "2", False, "invalid"), ("a", 6, "x", "1", "0", True, "saved"),
    ("a", 7, "x", "0", "3", True, "saved"), ("b", 1, "x", "0", "9", True, "saved"), ("b", 2, "y" * 501, "9", "8", True, "reason"),
    ("c", 1, "x", "0", "1", True, "unknown"), ("b", 3, "x", "9", "9", True, "unchanged"), ("b", 4, "x", "0", "1", True, "conflict"),
]
SCHEMA = "key string, ord long, reason string, expected_etag string, new_etag string, valid boolean"


def _frames(spark):
    edits = spark.createDataFrame([e[:6] for e in EDITS], SCHEMA)
    return edits, spark.createDataFrame([("a", "0"), ("b", "0")], "key string, etag string")


@pytest.mark.parametrize(("size", "summary"), [(512, 512), (2, 2), (1, 1)])
def test_batch_edits_at_any_bucket_size(spark, size, summary):
    edits, base = _frames(spark)
    wanted = {(e[0], e[1]): e[6] for e in EDITS}
    got = C.judge_edits(edits.repartition(3, "ord"), base, size, summary)
    assert {(r.key, r.ord): r.status for r in got.collect()} == wanted


@pytest.mark.parametrize("tags", [3, 7, 40, 10_000])
def test_long_histories(spark, tags):
    """Random edits over few and many etags, and stretches of a plain chain, against a plain loop."""
    rng = random.Random(tags)
    rows, now, wanted = [], "0", {}
    for i in range(600):
        want = now if rng.random() < 0.6 else str(rng.randrange(tags))
        give = str(rng.randrange(tags))
        rows.append(("k", i * 3, "r", want, give, True))
        status = "conflict" if want != now else "unchanged" if give == now else "saved"
        wanted[i * 3] = (status, now)
        now = give if status == "saved" else now
    edits, base = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("k", "0")], "key string, etag string")
    for size, summary in ((512, 512), (20, 5), (7, 3)):
        assert {r.ord: (r.status, r.current) for r in C.judge_edits(edits, base, size, summary).collect()} == wanted


def test_edit_stream_matches_batch(spark):
    edits, base = _frames(spark)
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    edits.where("ord <= 3").coalesce(1).write.parquet(f"{folder}/in")
    edits.where("ord > 3").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = apply_edit_stream(stream, base).writeStream.format("memory").queryName("edit_log").option("checkpointLocation", f"{folder}/cp").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.key, r.ord): r.status for r in spark.sql("select * from edit_log").collect()}
    assert got == {(e[0], e[1]): e[6] for e in EDITS}


def test_ledger_stream_is_idempotent(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    schema = "model string, purpose string, key string, value string, ts long"
    spark.createDataFrame([("m", "p", "a", "old", 1), ("m", "p", "a", "new", 2), ("m", "p", "b", "", 3)], schema).coalesce(1).write.parquet(f"{folder}/in")
    spark.createDataFrame([("m", "p", "a", "later", 9), ("m", "q", "a", "x", 4)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    for _ in range(2):
        ledger_stream(stream, f"{folder}/ledger", F.col("value") != "", f"{folder}/cp").awaitTermination()
    rows = spark.read.parquet(f"{folder}/ledger").collect()
    slots = {(r.purpose, r.key): r.value for r in rows}
    assert len(rows) == 2 and slots[("q", "a")] == "x" and slots[("p", "a")] in ("new", "later")


def test_ledger_stream_restarts_from_its_state(spark):
    """Two restarts; the seed fills slots, and the ledger's own files may be gone after the first batch."""
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    schema = "model string, purpose string, key string, value string, ts long"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    spark.createDataFrame([("m", "p", "a", "seeded", 0), ("m", "p", "z", "seeded", 0)], schema).write.parquet(f"{folder}/seed")
    found = []
    for number, rows in enumerate(([("m", "p", "a", "x", 1), ("m", "p", "b", "one", 2), ("m", "p", "b", "two", 3)], [("m", "p", "b", "late", 4), ("m", "p", "c", "", 5)], [("m", "p", "c", "good", 6), ("m", "p", "z", "y", 7), ("m", "q", "a", "other", 8)])):
        add(*rows)
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        target = f"{folder}/ledger{number}"  # a new folder each time: nothing written before can be read
        query = ledger_stream(stream, target, F.col("value") != "", f"{folder}/cp", f"{folder}/seed")
        query.awaitTermination()
        found += [(r.purpose, r.key, r.value) for r in spark.read.parquet(target).collect()]
        if number:
            assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)
    assert sorted(found) == [("p", "b", "two"), ("p", "c", "good"), ("q", "a", "other")]


def test_late_edits_come_out(spark):
    rows = [("a", 5, "r", "0", "1", True), ("a", 2, "r", "0", "2", True), ("a", 6, "r", "1", "3", True)]
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for row in rows:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    base = spark.createDataFrame([("a", "0")], "key string, etag string")
    query = apply_edit_stream(stream, base).writeStream.format("memory").queryName("late_log").option("checkpointLocation", f"{folder}/cp").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.ord, r.status) for r in spark.sql("select * from late_log").collect()}
    assert got == {(5, "saved"), (2, "conflict"), (6, "saved")}
