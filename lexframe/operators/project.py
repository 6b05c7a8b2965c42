"""Record order and projections with derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import annotation_ok, codepoint_label, first_sense, full_reading, mark_spans, plain_surface, reading_length, reading_matches, word_length
from lexframe.operators.curate import etag
from lexframe.operators.stats import LEVELS

# --- fixed values: labels ---
TAG_LABELS = {
    "s1": "소학교 1학년", "s2": "소학교 2학년", "s3": "소학교 3학년", "s4": "소학교 4학년", "s5": "소학교 5학년", "s6": "소학교 6학년",
    "j": "학년 외 상용한자", "h": "표외한자",
}
POS_LABELS = {"noun": "명사", "verb": "동사", "adjective": "형용사", "adverb": "부사", "function": "기능어"}
CHECK_LABELS = {"jmdict": "사전 확인", "phrase": "구", "unsure": "읽기 미확인"}
BAND_LABELS = {"1-1000": "NGSL 1-1000", "1001-2000": "NGSL 1001-2000", "2001-2809": "NGSL 2001-2809", "TSL": "TOEIC 전용"}


def label(c: Column, table: dict[str, str], rest: Column | None = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, c), F.lit("") if rest is None else rest)


def sorted_examples(c: Column) -> Column:
    """Examples by word length, first-sense length, reading length and first sense; source order on ties."""
    keyed = F.transform(c, lambda x, i: F.struct(
        word_length(x["w"]).alias("a"), F.length(first_sense(x["ko"])).alias("b"), reading_length(x["w"]).alias("c"), first_sense(x["ko"]).alias("d"), i.alias("i"), x.alias("x")))
    return F.transform(F.sort_array(keyed), lambda k: k["x"])


def sort_kanji(df: DataFrame) -> DataFrame:
    each = lambda c: F.transform_values(c, lambda _k, v: sorted_examples(v))
    return df.withColumn("readings", each("readings")).withColumn("except", each("except"))


def order_fields(df: DataFrame, order: list[str]) -> DataFrame:
    """Declared fields first and in order, unknown ones behind them."""
    return df.select(*[c for c in order if c in df.columns], *[c for c in df.columns if c not in order])


def _count(c: str) -> Column:
    return F.aggregate(F.map_values(c), F.lit(0), lambda a, v: a + F.size(v))


def project_kanji(df: DataFrame) -> DataFrame:
    def warned(e: Column) -> Column:
        return F.size(F.filter(e["value"], lambda x: ~(annotation_ok(x["w"]) & reading_matches(full_reading(x["w"]), e["key"]))))

    korean = F.array_distinct(F.flatten(F.map_values("korean")))
    record = F.struct("tag", "variant", "except", "readings", "korean", "korean_src", "note")
    return df.select(
        "key", codepoint_label(F.col("key")).alias("codepoint"), etag(record).alias("record_etag"), label(F.col("tag"), TAG_LABELS).alias("tag_label"),
        korean.alias("korean_display"), F.size(F.map_keys("readings")).alias("reading_count"), (_count("readings") + _count("except")).alias("example_count"),
        _count("readings").alias("regular_example_count"), _count("except").alias("exception_example_count"),
        F.aggregate(F.transform(F.map_entries("readings"), warned), F.lit(0), lambda a, n: a + n).alias("annotation_warnings"))


def project_grammar(df: DataFrame) -> DataFrame:
    examples = F.transform("examples", lambda x, i: F.struct(
        (i + 1).alias("position"), x["ja"].alias("ja"), F.array_join(mark_spans(F.coalesce(x["marked"], x["ja"])), "").alias("span"),
        plain_surface(F.array_join(mark_spans(F.coalesce(x["marked"], x["ja"])), "")).alias("span_plain"), plain_surface(x["ja"]).alias("plain")))
    unmarked = F.size(F.filter("examples", lambda x: F.coalesce(x["mark_method"], F.lit("")) == ""))
    return df.select("key", "head", label(F.col("level"), LEVELS).alias("level"), F.col("gloss_ko").alias("meaning"), examples.alias("examples"), unmarked.alias("unmarked"))


def project_vocab(df: DataFrame) -> DataFrame:
    derived = F.transform("senses", lambda s, i: F.struct(
        (i + 1).alias("position"), plain_surface(s["ja"]).alias("plain"), label(s["pos"], POS_LABELS, s["pos"]).alias("pos_label"), label(s["checked"], CHECK_LABELS).alias("check_label")))
    unverified = F.size(F.filter("senses", lambda s: s["checked"] != "jmdict"))
    return df.select("key", "rank", "list", label(F.col("band"), BAND_LABELS).alias("band_label"), "family", derived.alias("senses"), unverified.alias("unverified"))
