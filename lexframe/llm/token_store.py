"""Token ids in raw binary shards with a minimal perfect hash index for keyed access.

Documents are ranged by key, so the shards in order hold them in ascending key order. A shard file is
``LXTOKENS``, the length of a JSON header, the header, and its sections as raw little-endian arrays:

* ``ids``: all token ids of the shard (16 bits where the vocabulary allows, else 32), the end id after each document;
* ``ends``: for each document, the ids up to its end;
* ``keys``: the key of each document (documents without a key come first and are counted in the header);
* ``words``, ``sizes``: the perfect hash over the distinct keys;
* ``prints``, ``first``: for each slot the fingerprint of its key, and its first document (rows of one key are neighbours).

A task writes its own files, a new one whenever it holds ``SHARD_IDS`` ids, each under a name no other attempt has, and the manifest names the files of the
attempts that Spark accepted; so a lost executor leaves at most unnamed files.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexframe.llm.common import checkpointed, named, shared_folder
from lexframe.llm.perfect_hash import PerfectHash, fingerprints
from lexframe.llm.tokens import IdEncoder, kept_by_worker, loaded, ranks_of

MAGIC = b"LXTOKENS"
END_ID = 1
#: ids that a task holds before it writes a file, and ids that are read at once
SHARD_IDS, READ_IDS = 2**24, 2**20
MANIFEST = "shard int, part int, file string, n_docs long, n_ids long, low long, high long"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.FileSystem.from_uri("file://" + folder.removeprefix("file:"))


def write_shard(target: str, keys: np.ndarray, n_null: int, ids: list[bytes], wide: bool) -> None:
    """One shard file; ``keys`` (int64, ascending) of the documents after the ``n_null`` without one."""
    dtype = "<u4" if wide else "<u2"
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    distinct = keys[first].view(np.uint64)
    index = PerfectHash.build(distinct)
    slots = index.slots(distinct)
    prints, starts = np.empty(len(first), "<u4"), np.empty(len(first), "<u8")
    prints[slots], starts[slots] = fingerprints(distinct), first + n_null
    arrays = {"ends": ends.astype("<u8"), "keys": keys.astype("<i8"), "words": index.words.astype("<u8"), "sizes": index.sizes.astype("<i8"), "prints": prints, "first": starts}
    sections, at = {}, 0
    for name, array in arrays.items():
        sections[name] = (at, len(array), array.dtype.str)
        at += array.nbytes
    sections["ids"] = (at, int(ends[-1]) if len(ends) else 0, dtype)
    header = json.dumps({"sections": sections, "n_null": n_null}).encode()
    system, path = _place(target)
    with system.open_output_stream(path) as out:
        out.write(MAGIC + len(header).to_bytes(8, "little") + header)
        for array in arrays.values():
            out.write(array.tobytes())
        for x in ids:  # a document at a time: the payload never stands in memory twice
            out.write(np.frombuffer(x, "<u4").astype(dtype).tobytes())


class Shard:
    """Reads one shard: its index is loaded once, ids are read by range."""

    def __init__(self, source: str):
        system, path = _place(source)
        self.file = system.open_input_file(path)
        head = self.file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{source} is not a shard")
        size = int.from_bytes(head[8:], "little")
        header = json.loads(self.file.read_at(size, 16))
        self.base, self.sections, self.n_null = 16 + size, header["sections"], header["n_null"]
        self.ends, self.keys, self.prints, self.first = (self._read(n) for n in ("ends", "keys", "prints", "first"))
        self.index = PerfectHash(self._read("words"), self._read("sizes"))

    def _read(self, name: str, start: int = 0, stop: int | None = None) -> np.ndarray:
        at, length, dtype = self.sections[name]
        stop, width = length if stop is None else stop, np.dtype(dtype).itemsize
        return np.frombuffer(self.file.read_at((stop - start) * width, self.base + at + start * width), dtype)

    def documents(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, -1 where the shard does not hold it."""
        wanted = np.asarray(keys, np.int64).view(np.uint64)
        slots = self.index.slots(wanted)
        if not len(self.prints):
            return np.full(len(wanted), -1, np.int64)
        held = (slots >= 0) & (self.prints[slots] == fingerprints(wanted))
        found = np.where(held, self.first[slots].astype(np.int64), -1)
        # the stored key settles the one case in 2^32 in which a fingerprint matches by chance
        same = self.keys[np.maximum(found - self.n_null, 0)] == np.asarray(keys, np.int64)
        return np.where(same, found, -1)

    def ids(self, document: int, documents: int = 1) -> np.ndarray:
        """The ids of so many documents from ``document`` on, end ids included, as 32-bit integers."""
        start = int(self.ends[document - 1]) if document else 0
        return self._read("ids", start, int(self.ends[document + documents - 1])).astype("<u4")

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document of ``key``; an empty list if there is none."""
        at = int(self.documents(np.array([key]))[0])
        out = []
        while 0 <= at < len(self.ends) and self.keys[at - self.n_null] == key:
            out.append(self.ids(at))
            at += 1
        return out


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, folder: str | None = None, end_id: int = END_ID, white_space: str = "dropped", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all texts; the manifest, a row per file (shard, part, file, n_docs, n_ids, low, high).

    Null and empty texts give the end id alone. Null keys are written first; rows of one key stand
    side by side, ordered by a hash of the text, and are split over shards where they are many. An
    empty table gives an empty manifest. Other columns are not read.
    """
    folder = folder or f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    system, place = _place(folder)
    system.create_dir(place, recursive=True)
    wide = max(loaded(path).get_vocab_size(with_added_tokens=True), end_id + 1) > 2**16
    end, local = int(end_id).to_bytes(4, "little"), spark.sparkContext.broadcast({})
    ranks = spark.sparkContext.broadcast(ranks_of(path))  # bounded by the vocabulary
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), *((n, pa.int64()) for n in ("n_docs", "n_ids", "low", "high"))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(local, lambda: IdEncoder(path, white_space, ranks.value))
        shard, part = TaskContext.get().partitionId(), 0
        keys, ids, n_ids = [], [], 0

        def flushed() -> pa.RecordBatch:
            name = f"{folder}/shard-{shard:06d}-{part:04d}-{uuid.uuid4().hex}.tok"
            known = [k for k in keys if k is not None]  # those without come first
            write_shard(name, np.array(known, np.int64), len(keys) - len(known), ids, wide)
            row = (shard, part, name, len(ids), n_ids, known[0] if known else None, known[-1] if known else None)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(number)
                ids.append(encoder.encode(value) + end)
                n_ids += len(ids[-1]) // 4
                if n_ids >= SHARD_IDS:
                    yield flushed()
                    keys, ids, n_ids, part = [], [], 0, part + 1
        if ids:
            yield flushed()

    rows = docs.select(named(key).cast("long").alias("k"), named(text).alias("t"))
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(ranged.mapInArrow(write, MANIFEST))


def located(shard: Shard) -> np.ndarray:
    """The document of each key by the perfect hash, after those without a key; -1 for a key that is not found.

    The hash gives the first document of a key, the place in its run of equal keys the others.
    """
    held, keys = shard.documents(shard.keys), shard.keys
    at = np.arange(len(keys))
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    place = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.concatenate((np.arange(shard.n_null), np.where(held < 0, -1, held + place)))


def sums(shard: Shard, documents: np.ndarray) -> np.ndarray:
    """crc32 of the ids of each document, read in runs of neighbouring documents of about READ_IDS ids."""
    ends = shard.ends.astype(np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    out, at = np.zeros(len(documents), np.int64), 0
    while at < len(documents):
        first, stop = int(documents[at]), at + 1
        while stop < len(documents) and documents[stop] == documents[stop - 1] + 1 and ends[documents[stop]] - starts[first] <= READ_IDS:
            stop += 1
        ids, base = shard.ids(first, stop - at), int(starts[first])
        for i in range(at, stop):
            out[i] = zlib.crc32(ids[starts[documents[i]] - base : ends[documents[i]] - base].tobytes())
        at = stop
    return out


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32), read from the files through their index.

    ``start`` counts the ids of all documents before it. Every key is looked up in the perfect hash
    and checked against its fingerprint, and the rows are read where it leads; a walk over the
    positions is the check, and a key that is not found fails the read.
    """
    shards = manifest.count()
    earlier = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).select("file", "base")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, base in zip(batch["file"], batch["base"], strict=True):
                shard = Shard(name)
                found = located(shard)
                if not np.array_equal(found, np.arange(len(shard.ends))):
                    raise ValueError(f"the index of {name} does not lead to its documents")
                ends = shard.ends.astype(np.int64)
                starts = np.concatenate(([0], ends))[found]
                yield pd.DataFrame({
                    "doc_id": pd.array([None] * shard.n_null + shard.keys.tolist(), dtype="Int64"),
                    "start": starts + base,
                    "n_tokens": ends[found] - starts,
                    "ids_crc32": sums(shard, found),
                })

    return based.repartition(max(1, shards)).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def get_tokens(manifest: DataFrame, key: int) -> list[np.ndarray]:
    """Keyed access: the ids of every document of one key, from the shards whose range holds it."""
    names = [r.file for r in manifest.where((F.col("low") <= key) & (F.col("high") >= key)).orderBy("shard", "part").select("file").collect()]
    return [ids for name in names for ids in Shard(name).get(key)]
