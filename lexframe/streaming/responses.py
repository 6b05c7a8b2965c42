"""Response stream to ledger: accepted answers are appended as they arrive; which slots are filled is kept as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SLOT = ["model", "purpose", "key"]
LEDGER = "model string, purpose string, key string, value string, ts long"


def _settle(slot: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The latest accepted answer of the slot's first batch, unless the slot is filled or comes filled from the seed."""
    filled, best = state.exists, None
    for rows in parts:
        filled = filled or bool(rows["seeded"].any())
        if not filled and len(rows):
            top = rows.sort_values(["ts", "value"]).iloc[-1]
            best = top if best is None or (top["ts"], top["value"]) > (best["ts"], best["value"]) else best
    state.update((True,))
    if not filled and best is not None:
        yield pd.DataFrame([(*slot, best["value"], int(best["ts"]))], columns=[*SLOT, "value", "ts"])


def new_answers(answers: DataFrame, accept: Column, seed: DataFrame | None = None) -> DataFrame:
    """(model, purpose, key, value, ts) of the first accepted answer per slot, as a stream.

    ``answers`` and ``seed`` (the ledger so far) are streams; the seed's files are read once, into the
    state, and a slot they fill takes no answer. Later batches read the state only.
    """
    rows = answers.where(accept).select(*SLOT, "value", F.col("ts").cast("long").alias("ts"), F.lit(False).alias("seeded"))
    if seed is not None:
        rows = rows.unionByName(seed.select(*SLOT, "value", F.col("ts").cast("long").alias("ts"), F.lit(True).alias("seeded")))
    known = rows.na.fill("", SLOT)  # the state's key holds no nulls
    return known.groupBy(*SLOT).applyInPandasWithState(_settle, LEDGER, "filled boolean", "append", GroupStateTimeout.NoTimeout)


def ledger_stream(answers: DataFrame, ledger_path: str, accept: Column, checkpoint: str, seed_path: str | None = None) -> StreamingQuery:
    """Append accepted answers (model, purpose, key, value, ts) whose slot is still empty.

    ``seed_path`` holds the ledger as it stood before the stream was first started. Each micro-batch
    owns one folder and overwrites it, so a replayed batch, which begins from the state of the
    checkpoint, leaves the same rows; the ledger written so far is not read again.
    """
    spark = answers.sparkSession
    seed = None if seed_path is None else spark.readStream.schema(LEDGER).parquet(seed_path)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{ledger_path}/batch={number}")

    # the first folder makes the ledger readable before any batch has been written
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(f"{ledger_path}/batch=-1")
    return (
        new_answers(answers, accept, seed).writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
