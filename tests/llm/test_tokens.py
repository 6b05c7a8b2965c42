"""Token counts, packing and the token store against the library on awkward texts."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lexframe.llm import packing, perfect_hash, token_counts, token_store, tokens

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "a", "The", "don't", "'s", "é", "ſ", "é", "İ", "漢字", "12", "½", "!!", "<|endoftext|>", "Σ", "_", "\x00", "ǅ", "hello"]
SCHEMA = "doc_id long, text string, n_tokens string"
ROWS = [(1, "Hello  world", "x"), (2, None, "x"), (3, "", None), (None, "a <|endoftext|> b", "x"), (1, "Hello  world", "x"), (4, "word " * 3000, "x"), (5, "\n \n x", "x")]


def texts(n=3000):
    random.seed(5)
    return ["".join(random.choice(PARTS) for _ in range(random.randint(0, 12))) for _ in range(n)]


def test_chunks_equal_the_library():
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    counter, ids, lower = token_counts.Counter(BYTE, token_counts.whole_tokens(BYTE)), tokens.IdEncoder(BYTE), tokens.IdEncoder(WORD, "dropped")
    for x in texts():
        wanted = byte.encode(x, add_special_tokens=False).ids
        assert counter.count(x) == len(wanted), x
        assert ids.encode(x) == np.array(wanted, "<u4").tobytes(), x
        assert lower.encode(x) == np.array(word.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x


def test_ranks_equal_the_library():
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    ids, lower = tokens.IdEncoder(BYTE, ranks=tokens.ranks_of(BYTE)), tokens.IdEncoder(WORD, "dropped", tokens.ranks_of(WORD))
    plain = ["The", "don't", "'S", " ", "  ", "\n", "\t", "é", "Ü", "12", "½", "!!", "_", "unbelievably", "aaaa", "zzzzzzq", "\xa0", "ŉ", "ß", "ǅ", "İ", "'ll", "×", "a" * 1200, " " * 1200, "<|endoftext|>", "漢"]
    random.seed(6)
    cases = ["".join(random.choice(plain[:20] if i % 4 else plain) for _ in range(random.randint(0, 14))) for i in range(4000)]
    cases += ["ab" * 60_000, "a" * 100_000, "\n" * 50_000, "w " * 50_000, "é" * 999 + " ", "x" * 1000, "x" * 1001]
    for x in cases:
        assert ids.encode(x) == np.array(byte.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x[:80]
        assert lower.encode(x) == np.array(word.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x[:80]


def test_memory_is_bounded():
    memo = tokens.Memo(str.upper, limit=3, longest=4)
    assert [memo[x] for x in ["a", "b", "c", "d", "a", "long one"]] == ["A", "B", "C", "D", "A", "LONG ONE"]
    assert len(memo) <= 3 and len(memo.old) <= 3 and "long one" not in memo


def test_whole_tokens_are_proven():
    tokenizer, whole = Tokenizer.from_file(BYTE), token_counts.whole_tokens(BYTE)
    assert " the" in whole and "<|endoftext|>" not in whole
    assert all(len(tokenizer.encode(w, add_special_tokens=False).ids) == 1 for w in sorted(whole)[::97])


def test_count_tokens(spark):
    out = token_counts.count_tokens(spark, spark.createDataFrame(ROWS, SCHEMA), BYTE).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    for r in out:
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 512)
    assert len(out) == len(ROWS)
    assert token_counts.count_tokens(spark, spark.createDataFrame([], SCHEMA), BYTE).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 20, 100])
    histogram = {n: rng.choice([1, 2, 5, 30, 500]) for n in range(1, capacity + 1) if rng.random() < 0.5}
    slots, number = packing.plan(histogram, capacity)
    seen, bins = dict.fromkeys(histogram, 0), {}
    for length, first, count, per_bin, sequence, place in slots:
        assert first == seen[length]
        seen[length] += count
        for r in range(count):
            bins.setdefault(sequence + r // per_bin, []).append((place + r % per_bin * length, length))
    assert seen == histogram and len(bins) == number
    for members in bins.values():
        end = 0
        for place, length in sorted(members):
            assert place == end
            end += length
        assert end <= capacity


def test_packing(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = packing.pack(spark, packing.pieces(spark, docs, BYTE), ["doc_id", "piece", "ids_crc32"], buckets=4).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    wanted = []
    for k, text, _ in ROWS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        head = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        cuts = [0, head, *range(head + 2048, len(ids) + 1, 2048)]
        wanted += [(str(k), i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(wanted)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        assert [a for a, _ in sorted(members)] == [sum(n for _, n in sorted(members)[:i]) for i in range(len(members))]
        assert sum(n for _, n in members) <= 2048
    empty = packing.pieces(spark, spark.createDataFrame([], SCHEMA), BYTE)
    assert packing.pack(spark, empty, ["doc_id", "piece", "ids_crc32"]).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000)).astype(np.uint64)
    index = perfect_hash.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert len(perfect_hash.PerfectHash.build(keys[:0]).slots(keys[:0])) == 0
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.PerfectHash.build(np.array([1, 1], np.uint64))


@pytest.mark.parametrize("held", [2**24, 3])
def test_store_round_trip(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(token_store, "SHARD_IDS", held)
    monkeypatch.setattr(token_store, "READ_IDS", held)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    manifest = token_store.write_tokens(spark, docs, WORD, f"file://{tmp_path}/tokens")
    out = token_store.read_tokens(manifest).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORD)
    ids = {(k, t): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t, _ in ROWS}
    assert [r.doc_id for r in out] == [None, 1, 1, 2, 3, 4, 5]
    wanted = sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in [ids[k, t] for k, t, _ in ROWS])
    assert sorted((r.n_tokens, r.ids_crc32) for r in out) == wanted
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(len(out))]
    assert [x.tolist() for x in token_store.get_tokens(manifest, 1)] == [ids[1, "Hello  world"]] * 2
    assert token_store.get_tokens(manifest, 77) == []
    empty = token_store.write_tokens(spark, spark.createDataFrame([], SCHEMA), WORD, f"file://{tmp_path}/none")
    assert token_store.read_tokens(empty).count() == 0
