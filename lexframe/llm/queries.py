"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexframe.llm import block_codes, hilbert_shards, license_scan, mixing, near_dedup, packing, personal_data, quality_model, quality_rules, spelling, token_counts, token_store, top_k
from lexframe.llm.common import table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(spark, docs, public_tokenizers.path(BYTE_BPE)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(spark, docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.training_order(mixing.curriculum(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(spark, table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return hilbert_shards.shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "cell")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(spark, docs, table(spark, sf_dir, "labels"))
    return quality_model.score(spark, docs, model).select("doc_id", "held_out", "score", "predicted")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = packing.pieces(spark, docs, public_tokenizers.path(BYTE_BPE))
    return packing.pack(spark, parts, ["doc_id", "piece", "ids_crc32"])


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_store.read_tokens(token_store.write_tokens(spark, docs, public_tokenizers.path(WORD_BPE)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = personal_data.find(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = block_codes.compress(spark, table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_curriculum_mixing": op3_curriculum_mixing,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_near_dedup": op6_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_token_store": op9_token_store,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_personal_data": op12_personal_data,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES = {
    "op2_license_scan": license_scan.ORACLE,
    "op3_curriculum_mixing": mixing.ORACLE,
    "op4_exact_top_k": top_k.ORACLE,
    "op6_near_dedup": near_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_vector_codes": block_codes.ORACLE,
}
