"""Token counts with a whole-token shortcut.

Offline, every string of the vocabulary is encoded alone: those that give exactly one token are
proven whole. In texts, a pre-token that is a proven string counts one without any merging; only
the other pre-tokens are merged (by the library). Counts equal the library's for the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from lexframe.llm.common import named
from lexframe.llm.tokens import Chunks, Merger, byte_alphabet, kept_by_worker


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as their own single token."""
    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    byte_of = {letter: byte for byte, letter in byte_alphabet().items()}
    strings, ids = [], []
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            strings.append(bytes(byte_of[c] for c in token).decode("utf-8"))
            ids.append(number)
        except (UnicodeDecodeError, KeyError):
            continue
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(s for s, i, e in zip(strings, ids, encoded, strict=True) if e.ids == [i] and s not in special)


class Counter:
    """Counts the tokens of one text; one per worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        merger = Merger(path, "kept", len, lambda token: 1 if token in whole else None)
        self.chunks = Chunks(lambda piece: sum(merger.values(piece)), merger.word)

    def count(self, text: str | None) -> int:
        return sum(self.chunks.pieces(text)) if text else 0


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    Null and empty texts count 0. Special strings inside a text count as the library's default does.
    Repeated rows are counted alike; columns named like a result are replaced. The broadcast set is
    bounded by the vocabulary.
    """
    proven, local = spark.sparkContext.broadcast(whole_tokens(path)), spark.sparkContext.broadcast({})

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = kept_by_worker(local, lambda: Counter(path, proven.value))
        for batch in batches:
            yield pd.Series([counter.count(x) for x in batch], dtype="int64")

    kept = [named(c) for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    whole = F.coalesce(named(text), F.lit(""))
    counted = docs.select(*kept, F.octet_length(whole).cast("long").alias("n_bytes"), tokens(whole).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
