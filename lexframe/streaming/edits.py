"""Edit stream: the current etag per key is the state; stale edits are conflicts, not late data."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUTPUT = "key string, ord long, current string, status string"


def _judge(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(parts)).sort_values("ord")
    (now,) = state.get if state.exists else (rows["start_etag"].iloc[0],)
    out = []
    for r in rows.itertuples():
        reason = (r.reason or "").strip()
        met = now
        if not reason or len(reason) > 500:
            status = "reason"
        elif now is None:
            status = "unknown"
        elif r.expected_etag != now:
            status = "conflict"
        elif not r.valid:
            status = "invalid"
        elif r.new_etag == now:
            status = "unchanged"
        else:
            status, now = "saved", r.new_etag
        out.append((key[0], int(r.ord), met, status))
    state.update((now,))
    yield pd.DataFrame(out, columns=["key", "ord", "current", "status"])


def apply_edit_stream(edits: DataFrame, base: DataFrame) -> DataFrame:
    """(key, ord, current, status) as edits arrive; rules as in the batch form.

    ``edits`` (streaming): key, ord, reason, expected_etag, new_etag, valid.  ``base``: key, etag.
    An edit that arrives after later ones is judged against the etag of its arrival, so every edit has
    a row. A restarted batch begins from the state of the checkpoint and repeats its rows.
    """
    started = edits.join(base.select("key", F.col("etag").alias("start_etag")), "key", "left").withColumn("key", F.col("key").cast("string"))
    return started.groupBy("key").applyInPandasWithState(
        _judge, _OUTPUT, "etag string", "append", GroupStateTimeout.NoTimeout)
