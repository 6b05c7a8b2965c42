"""The pipeline's stages in order, on a whole small corpus."""

import corpus_pipeline
from lexframe.llm import near_dedup, quality_rules

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    source = docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = kept[name] = spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert docs.columns == source.columns
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in kept.items()}
    assert sorted(ids["quality_rules"]) == sorted(r.doc_id for r in quality_rules.verdicts(source).where("kept").collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(labels.get(i, 1) == 1 for i in ids["quality_classifier"])
    assert {i for i in ids["quality_rules"] if labels.get(i) == 1} == {i for i in ids["quality_classifier"] if labels.get(i) == 1}
    alone = near_dedup.near_duplicates(spark, kept["quality_classifier"]).where("kept").count()
    assert len(ids["near_dedup"]) == len(set(ids["near_dedup"])) == alone
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and max(map(ids["mixing"].count, set(ids["mixing"]))) <= 2
    assert sorted(set(ids["packing"])) == sorted(set(ids["mixing"]))
    assert kept["packing"].where("piece = 0").count() == len(ids["mixing"])
    sums = kept["packing"].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in sums) <= 2048
    assert len(sums) <= 1.05 * sum(r[1] for r in sums) / 2048 + 1


def test_empty_and_null_rows(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None,) * len(source.columns)] * 2, source.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, source.limit(0), SF).count() == 0
        assert stage(spark, odd, SF).count() >= 0
