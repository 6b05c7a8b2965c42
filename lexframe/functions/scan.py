"""Many strings looked for in many texts at once: a trie of UTF-8 bytes as arrays, walked from all places of a batch together."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, functions as F

#: bytes of text walked at a time, so that what a step reads and writes stays in the processor's cache
CHUNK = 1 << 16
#: matches that are counted together
LOT = 1 << 21


class Trie(NamedTuple):
    """``step[node * width + kind[byte]]`` is the node behind ``node``, 0 if there is none; ``ends[node]`` the string that ends there, or -1."""

    kind: np.ndarray
    step: np.ndarray
    ends: np.ndarray
    width: int
    depth: int


def build_trie(coded: list[bytes], cells: int) -> Trie | None:
    """The trie of distinct non-empty strings, given in UTF-8; None if its table would have more than ``cells`` cells."""
    used = sorted(set(b"".join(coded)))
    kind, width = np.zeros(256, np.int32), len(used) + 1
    kind[used] = np.arange(1, width)
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for number, code in enumerate(coded):
        node = 0
        for byte in code:
            below = children[node].get(byte)
            if below is None:
                if (len(children) + 1) * width > cells:
                    return None
                below = children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = below
        ends[node] = number
    step = np.zeros((len(children), width), np.int32)
    for node, row in enumerate(children):
        if row:
            step[node, kind[list(row)]] = list(row.values())
    return Trie(kind, step.ravel(), np.array(ends, np.int32), width, max(map(len, coded), default=0))


def _walker() -> Callable[..., tuple[np.ndarray, np.ndarray]]:
    # nested, as all below, so that it goes to executors with its code
    def once(keys: list[np.ndarray]) -> np.ndarray:
        keys = np.sort(np.concatenate([np.zeros(0, np.int64), *keys]))
        return keys[np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]])]

    def walk(trie: tuple, texts: pa.Array, lowest: np.ndarray | None = None, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, string) of every string that stands in a text of a row's array, each once and in order."""
        kind, step, ends, width, depth = trie
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        flat = texts.flatten().cast(pa.large_string())
        if not len(flat):
            return owner, owner
        _, places, data = flat.buffers()
        starts = np.frombuffer(places, np.int64)[flat.offset : flat.offset + len(flat) + 1]
        first, total, starts = int(starts[0]), int(starts[-1] - starts[0]), starts - starts[0]
        met = []
        for low in range(0, total, chunk):
            high = min(low + chunk, total)
            held = np.frombuffer(data, np.uint8, min(high + depth, total) - low, first + low)
            code = np.zeros(high - low + depth, np.int32)
            code[: len(held)] = kind[held]
            a, b = np.searchsorted(starts, low, "right") - 1, np.searchsorted(starts, high, "left")
            text = np.repeat(np.arange(a, b), np.diff(np.clip(starts[a : b + 1], low, high)))
            node, here = step[code[: high - low]], []
            at = np.flatnonzero(node)
            node, length = node[at], 1
            while len(at):
                end = ends[node]
                hit = np.flatnonzero(end >= 0)
                place, which = at[hit], end[hit]
                row = text[place]
                whole = low + place + length <= starts[row + 1]
                of, which = owner[row[whole]], which[whole]
                if lowest is not None:
                    begins, row = low + place[whole], row[whole]
                    kept = (lowest[which] <= floor[of]) | ((starts[row] == begins) & (starts[row + 1] == begins + length))
                    of, which = of[kept], which[kept]
                here.append(of * len(ends) + which)
                node = step[node * width + code[at + length]]
                on = np.flatnonzero(node)
                at, node, length = at[on], node[on], length + 1
            met.append(once(here))
        keys = once(met)
        return keys // len(ends), keys % len(ends)

    chunk = CHUNK
    return walk


def found_in(trie: Broadcast, lowest: Broadcast) -> Callable[[Column, Column], Column]:
    """A function of an array of texts and a level: the numbers of the trie's strings that are a whole text, or stand in one and have a ``lowest`` level not above."""
    walk = _walker()

    @F.arrow_udf("array<int>")
    def found(texts: pa.Array, level: pa.Array) -> pa.Array:
        row, string = walk(trie.value, texts, lowest.value, level.to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32()), pa.array(string, pa.int32()))

    return found


#: what ``tallied`` gives
TALLY = "number int, level long, n long"


def tallied(trie: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over (level, texts): the rows in which a string stands, per string and level; some rows for each, to be added up."""
    walk, lot = _walker(), LOT

    def counts(levels: list[np.ndarray], rows: list[np.ndarray], strings: list[np.ndarray]) -> pa.RecordBatch:
        known, at = np.unique(np.concatenate(levels), return_inverse=True)
        keys, n = np.unique(np.concatenate(strings) * len(known) + at[np.concatenate(rows)], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys // len(known), pa.int32()), pa.array(known[keys % len(known)]), pa.array(n, pa.int64())], ["number", "level", "n"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, rows, strings, before, size = [], [], [], 0, 0
        for batch in batches:
            row, string = walk(trie.value, batch.column("texts"))
            levels.append(batch.column("level").to_numpy(zero_copy_only=False))
            rows.append(row + before)
            strings.append(string)
            before, size = before + len(batch), size + len(row)
            if size >= lot:
                yield counts(levels, rows, strings)
                levels, rows, strings, before, size = [], [], [], 0, 0
        if size:
            yield counts(levels, rows, strings)

    return tally
