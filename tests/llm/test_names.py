"""Every operator carries columns whose names meet its own, or hold a backtick, through unchanged."""

import public_tokenizers as P
import pytest

from lexframe.llm import hilbert_shards, license_scan, mixing, packing, personal_data, quality_model, quality_rules, token_counts

NAMES = (
    "place", "sequence", "first", "per_bin", "bucket", "row", "rank", "key", "a`b", "a.b", "__id", "__hash", "__text", "__order", "__bucket", "__row", "__v", "__y", "__n", "__tie", "__source", "i", "k", "t",
    "h", "weight", "slot_length", "before", "pieces", "stop", "n", "v", "kind", "email", "c0", "end", "__key", "__rank", "__first", "__axis0",
)
ROWS = [(i, f"cc by words of text {i % 3} mail{i}@host.de", "s" if i % 2 else None, "en", *(f"{n}{i}" for n in NAMES)) for i in range(6)]


def apply(name, spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    return {
        "counts": lambda: token_counts.count_tokens(spark, docs, P.path("byte_bpe_50k.json")),
        "license": lambda: license_scan.scan(spark, docs),
        "mixing": lambda: mixing.training_order(mixing.curriculum(docs)),
        "passes": lambda: mixing.curriculum(docs, passes=True),
        "shards": lambda: hilbert_shards.shards(docs),
        "classifier": lambda: quality_model.score(spark, docs, quality_model.train(spark, docs, labels)),
        "packing": lambda: packing.pack(spark, packing.pieces(spark, docs, P.path("byte_bpe_50k.json")), ["doc_id", "piece", "ids_crc32"]),
        "rules": lambda: quality_rules.verdicts(docs),
        "personal": lambda: personal_data.find(spark, docs)[0],
    }[name]()


@pytest.mark.parametrize("name", ["counts", "license", "mixing", "passes", "shards", "classifier", "packing", "rules", "personal"])
def test_names(spark, name):
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in NAMES)
    docs = spark.createDataFrame(ROWS, f"doc_id long, text string, source string, lang string, {fields}")
    out = apply(name, spark, docs).collect()
    assert out and {r.doc_id for r in out} == set(range(6))
    for r in out:
        for n in NAMES:
            assert r[n] == f"{n}{r.doc_id}", n
