"""The corpus pipeline: stages over ``documents``, each calling one operator of lexframe.llm.

Each stage works on all that its predecessor kept. All but the last return the columns they were given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.llm import mixing, near_dedup, packing, quality_model, quality_rules
from lexframe.llm.common import named, packed_row, shared_folder, table, unpacked

#: the stages fit a model, link near-duplicates and plan over histograms, which SQL cannot express
ORACLE_SQL = None


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return docs.where(quality_rules.verdict(F.col("text"))["kept"])


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labels of its own input."""
    model = quality_model.train(spark, docs, table(spark, sf_dir, "labels"))
    return quality_model.score(spark, docs, model).where("predicted = 1").select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, and one row where rows of an id repeat; rows without id stay.

    Of the rows of an id the one with the least hash of its text, then of the whole row, is taken.
    """
    kept = near_dedup.near_duplicates(spark, docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    order = F.struct(F.xxhash64("text").alias("t"), F.xxhash64(*map(named, docs.columns)).alias("r"))
    with_id = docs.where("doc_id IS NOT NULL")
    first = with_id.select(F.col("doc_id").alias("i"), order.alias("o")).groupBy("i").agg(F.min("o").alias("o")).join(kept, F.col("i") == F.col("id"), "left_semi")
    rows = with_id.select(packed_row(docs.columns).alias("row"), F.col("doc_id").alias("key"), order.alias("h"))
    # rows that agree in both hashes are copies of one row
    single = rows.join(first, (rows["key"] == first["i"]) & (rows["h"] == first["o"])).dropDuplicates(["key", "h"])
    return single.select(*unpacked("row", docs.columns)).union(docs.where("doc_id IS NULL"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every pass in which the mix takes a document, in training order.

    Where a source's demand ends inside a document, the document is in if at least half of it is taken.
    """
    mixed = mixing.curriculum(docs, passes=True).where("2 * pass_words >= size").orderBy("position", "doc_id")
    return mixed.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the packed sequences."""
    parts = packing.pieces(spark, docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(spark, parts, ["doc_id", "piece", "ids_crc32"])


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage before it keeps is written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
