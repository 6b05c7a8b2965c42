"""Nested JSON payloads to flat tables and back; verified writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from lexframe.operators.order import SUMMARY, running_sum
from lexframe.session import checkpointed


def flatten_payload(df: DataFrame, raw: str, record_schema: str) -> tuple[DataFrame, DataFrame]:
    """(records: payload, ord, key, record) and the payloads refused for broken JSON or repeated keys.

    ``df``: payload (an id) and the raw text.  Source order is kept as ``ord``.
    """
    good = F.try_parse_json(raw).isNotNull()
    parsed = F.from_json(raw, f"map<string,{record_schema}>")
    rows = df.where(good).select("payload", F.posexplode_outer(parsed).alias("ord", "key", "record")).where("key is not null")
    return rows, df.where(~F.coalesce(good, F.lit(False))).select("payload")


def flatten_blocks(df: DataFrame, raw: str, record_schema: str) -> tuple[DataFrame, DataFrame]:
    """The same for payloads that come in blocks: ``df`` holds payload, block (ascending) and the raw text of each.

    A large payload is many rows, so none of it has to fit into one; keys are compared over all of
    its blocks by an aggregate, and ``ord`` runs on from block to block. The texts are materialised with
    their keys, so that what is done before a text is known, and by keys and numbers alone, is done once.
    """
    keys = F.map_keys(F.from_json(raw, f"map<string,{record_schema}>"))
    blocks = checkpointed(df.select("payload", F.col("block").cast("long").alias("block"), F.col(raw).alias("raw"), F.when(F.try_parse_json(raw).isNotNull(), F.coalesce(keys, F.array())).alias("keys")))
    twice = blocks.select("payload", F.explode("keys").alias("key")).groupBy("payload", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("payload")
    refused = checkpointed(blocks.where("keys is null").select("payload").union(twice).distinct())
    kept = blocks.where("keys is not null").join(refused, "payload", "left_anti")
    ends = running_sum(kept.groupBy("payload", "block").agg(F.sum(F.size("keys")).alias("n")), ["payload"], ["block"], F.floor(F.col("block") / SUMMARY), F.col("n"), "end")
    texts = kept.join(ends.select("payload", "block", (F.col("end") - F.col("n")).alias("before")), ["payload", "block"])
    records = texts.select("payload", "before", F.posexplode(F.from_json("raw", f"map<string,{record_schema}>")).alias("at", "key", "record"))
    return records.select("payload", (F.col("before") + F.col("at")).cast("int").alias("ord"), "key", "record"), refused


def flatten_examples(records: DataFrame, bucket: str) -> DataFrame:
    """(payload, key, reading_ord, reading, ex_ord, example) of a map from reading to an example array."""
    readings = records.select("payload", "key", F.posexplode(F.col(f"record.{bucket}")).alias("reading_ord", "reading", "examples"))
    return readings.select("payload", "key", "reading_ord", "reading", F.posexplode("examples").alias("ex_ord", "example"))


def nest_examples(flat: DataFrame) -> DataFrame:
    """(payload, key, bucket): the map rebuilt in its order.  A record holds a bounded list."""
    # dealt once, by record; both groupings and a join by record follow where the rows then lie
    per = flat.repartition("payload", "key").groupBy("payload", "key", "reading_ord", "reading").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("ex_ord", "example"))), lambda x: x["example"]).alias("examples"))
    entries = F.sort_array(F.collect_list(F.struct("reading_ord", "reading", "examples")))
    return per.groupBy("payload", "key").agg(F.map_from_entries(F.transform(
        entries, lambda e: F.struct(e["reading"].alias("key"), e["examples"].alias("value")))).alias("bucket"))


def write_verified(df: DataFrame, path: str, contract: Callable[[DataFrame], DataFrame] | None = None, base: str | None = None) -> int:
    """Write aside, read back, check, then move into place; returns the number of rows.

    The base is never overwritten with its own materialisation, and a failed check leaves the
    target as it was.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(hadoop)
    if base is not None and fs.makeQualified(jvm.org.apache.hadoop.fs.Path(base)).equals(fs.makeQualified(target)):
        raise ValueError("the base is not overwritten; give another output path")
    aside = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".staging")
    rows = F.count(F.lit(1))
    seen = Observation("written")
    df.observe(seen, rows.alias("rows")).write.mode("overwrite").parquet(aside.toString())
    back = spark.read.schema(df.schema).parquet(aside.toString())
    written, expected = back.agg(rows).first()[0], seen.get["rows"]
    problem = None if written == expected else f"{written} rows read back, {expected} expected"
    if problem is None and contract is not None:
        found = contract(back).limit(5).collect()
        problem = f"contract: {[r.asDict() for r in found]}" if found else None
    if problem is not None:
        fs.delete(aside, True)
        raise ValueError(problem)
    old = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".old")
    # a run that died between the two moves has left the target as .old: it goes back first
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    elif fs.exists(old):
        fs.delete(old, True)
    moved = fs.exists(target) and fs.rename(target, old)
    if not fs.rename(aside, target):
        if moved:
            fs.rename(old, target)
        raise OSError(f"cannot move {aside} into place")
    if fs.exists(old):
        fs.delete(old, True)
    return written
