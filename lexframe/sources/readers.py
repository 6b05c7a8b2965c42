"""Readers of the text sources: lists, dictionary entries, frequencies, character properties.

Every ``read_*`` adds only the file scan to a ``parse_*`` that works on any DataFrame of raw text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lexframe.functions.text import not_blank, strip
from lexframe.operators.order import first_occurrence

# --- fixed values: the bytes cp1252 maps differently from latin-1, dictionary word classes ---
_C1 = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
C1_CONTROLS = "".join(chr(b) for b in _C1)
C1_LETTERS = bytes(_C1).decode("cp1252")
GRAMMATICAL = "particle|auxiliary|expressions|conjunction|prefix|suffix|interjection|copula|counter"
CONTENT = "noun|verb|adjectiv|adverb"
CJK = r"\x{3400}-\x{9FFF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}々〆"
HANJA = r"[\x{2E80}-\x{2EFF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]+"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, text): lines with an order that follows the file across its splits.

    A file that is not valid UTF-8 anywhere is taken as cp1252 as a whole; a leading mark is dropped.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"))
    bad = raw.where(~F.is_valid_utf8("value")).select("file").distinct().withColumn("_bad", F.lit(True))
    latin = F.translate(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), C1_CONTROLS, C1_LETTERS)
    rows = raw.join(bad, "file", "left")
    text = F.when(F.col("_bad"), latin).otherwise(F.make_valid_utf8("value"))
    return rows.select("file", "block", "seq", F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "\r$", "").alias("text"))


def _used(df: DataFrame) -> DataFrame:
    cells = F.from_csv("text", "a string, b string, c string")
    return df.withColumn("_c", cells).where((strip(F.coalesce("_c.a", F.lit(""))) != "") & ~F.col("_c.a").startswith("##"))


def parse_wordlist(df: DataFrame, source: str) -> DataFrame:
    """(word, list, rank, sfi, form) from CSV lines ``text`` without their header.

    Comments and blank rows are dropped; a rank that is not a whole number fails the read.
    """
    rank = strip(F.coalesce("_c.b", F.lit("")))
    wrong = F.raise_error(F.concat(F.lit(f"{source}: not a rank: "), F.col("text"))).cast("int")
    return _used(df).select(
        F.lower(strip(F.col("_c.a"))).alias("word"), F.lit(source).alias("list"), F.coalesce(rank.try_cast("int"), wrong).alias("rank"),
        F.col("_c.c").try_cast("double").alias("sfi"), strip(F.col("_c.a")).alias("form"))


def read_wordlist(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The first used row of every file is its header, which must name the headword column."""
    lines = read_lines(spark, path)
    place = F.struct("block", "seq")
    heads = _used(lines).groupBy("file").agg(F.min(place).alias("_first"), F.min_by(F.lower(strip(F.col("_c.a"))), place).alias("_head"))
    wrong = F.raise_error(F.concat("file", F.lit(": the first cell is not the headword column: "), "_head")).cast("boolean")
    heads = heads.withColumn("_ok", F.when(F.col("_head").isin("lemma", "word"), F.lit(True)).otherwise(wrong))
    body = lines.join(heads, "file").where(F.col("_ok") & (place != F.col("_first")))
    return parse_wordlist(body.select("text"), source)


def parse_families(df: DataFrame) -> DataFrame:
    """(head, forms): one family per CSV line; a head that stands on two lines fails the read."""
    cells = F.filter(F.transform(F.split("text", ",", -1), strip), lambda x: x != "")
    rows = df.where((strip(F.col("text")) != "") & ~F.col("text").startswith("##")).select(cells.alias("forms")).where(F.size("forms") > 0)
    heads = rows.groupBy(F.lower(F.get("forms", F.lit(0))).alias("head")).agg(F.count(F.lit(1)).alias("_n"), F.min("forms").alias("forms"))
    twice = F.raise_error(F.concat(F.lit("a family head stands on two lines: "), "head")).cast("array<string>")
    return heads.select("head", F.when(F.col("_n") == 1, F.col("forms")).otherwise(twice).alias("forms"))


def read_families(spark: SparkSession, path: str) -> DataFrame:
    return parse_families(read_lines(spark, path))


def with_families(words: DataFrame, families: DataFrame) -> DataFrame:
    """Adds ``family``; a word without one is its own family."""
    f = families.select(F.col("head").alias("word"), F.col("forms").alias("_f"))
    return words.join(f, "word", "left").withColumn("family", F.coalesce("_f", F.array("form"))).drop("_f", "form")


def parse_entries(df: DataFrame, order: str) -> DataFrame:
    """(surface, reading, reading_ord, pos) from raw dictionary entries ``text``, ordered by ``order``.

    ``reading_ord`` is a struct (place of the entry, number of the reading), which sorts as the text does.
    Every written form takes every reading of its entry; an entry without one maps its readings to
    themselves.  A pair keeps its first place; tags of all its entries are united.
    """
    def all_of(tag: str) -> Column:
        return F.regexp_extract_all("text", F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))

    rows = df.select(F.col(order).alias("_o"), all_of("keb").alias("kebs"), all_of("reb").alias("rebs"), F.array_distinct(all_of("pos")).alias("pos"))
    readings = rows.select("_o", "kebs", "pos", F.posexplode("rebs").alias("i", "reading")).where("reading <> ''")
    pairs = readings.select("_o", "i", "pos", "reading", F.explode(F.when(F.size("kebs") > 0, F.col("kebs")).otherwise(F.array("reading"))).alias("surface"))
    return pairs.groupBy("surface", "reading").agg(
        F.min(F.struct("_o", "i")).alias("reading_ord"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("pos")))).alias("pos"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Splits the file at entry ends, so no XML parser meets the undeclared entities."""
    raw = spark.read.text(path, lineSep="</entry>").select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("o"),
        F.col("value").alias("text"))
    return parse_entries(raw.where(F.col("text").contains("<entry>")), "o")


def lexicon(dictionary: DataFrame) -> DataFrame:
    """(word, plane): written and spoken content words of 2 to 12 characters, readings from 3."""
    lowered = F.lower(F.array_join("pos", " "))
    bad = F.forall("pos", lambda p: F.lower(p).rlike(GRAMMATICAL))
    content = dictionary.where((F.size("pos") > 0) & lowered.rlike(CONTENT) & ~bad)
    good = content.where(F.length("surface").between(2, 12) & F.col("surface").rlike(f"[{CJK}]"))
    spoken = good.where(F.length("reading").between(3, 12) & F.col("reading").rlike("^[ぁ-ゟァ-ヿー]+$"))
    return good.select(F.col("surface").alias("word"), F.lit("written").alias("plane")).distinct().unionByName(
        spoken.select(F.col("reading").alias("word"), F.lit("spoken").alias("plane")).distinct())


def read_frequency(spark: SparkSession, path: str) -> DataFrame:
    """(lemma, form, freq) of a tab-separated list with named columns; unusable rows dropped."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="")
    return rows.select("lemma", F.coalesce("lForm", F.lit("")).alias("form"), F.col("frequency").try_cast("long").alias("freq")).where(
        (F.coalesce("lemma", F.lit("")) != "") & F.col("freq").isNotNull())


def parse_char_props(df: DataFrame, props: list[str]) -> DataFrame:
    """(ch, prop, value) from ``U+XXXX, prop, values`` lines; qualifiers behind a colon are dropped."""
    rows = df.where(~F.col("text").startswith("#")).select(F.split("text", "\t", 3).alias("p")).where(F.size("p") == 3)
    wanted = rows.where(F.get("p", F.lit(1)).isin(*props))
    ch = F.decode(F.unhex(F.lpad(F.substring(F.get("p", F.lit(0)), 3, 8), 8, "0")), "UTF-32")
    value = F.explode(F.filter(F.split(F.get("p", F.lit(2)), " ", -1), lambda v: v != ""))
    return wanted.select(ch.alias("ch"), F.get("p", F.lit(1)).alias("prop"), value.alias("value")).select(
        "ch", "prop", F.substring_index("value", ":", 1).alias("value"))


def read_char_props(spark: SparkSession, path: str, props: list[str]) -> DataFrame:
    return parse_char_props(spark.read.text(path).withColumnRenamed("value", "text"), props)


def parse_sections(df: DataFrame, keys: list[str], order: list[str], bucket: Column, header: str, count: str) -> tuple[DataFrame, DataFrame]:
    """(items: keys, section, declared, value) and (keys, section, declared, found) of wrong counts.

    A line matching ``header`` (one group: the name) opens a section, a line matching ``count`` (one
    group) declares its size, the other non-blank lines list its members.
    """
    text, at = F.col("text"), F.struct(*order)
    name = F.when(text.rlike(header), F.regexp_extract(text, header, 1))
    rows = df.where(not_blank(text)).withColumn("_bucket", bucket.cast("long")).withColumn("_name", name)
    # number and name from one window over the lines and one row per bucket
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, "_bucket").agg(F.count("_name").alias("_part"), F.max_by("_name", F.when(F.col("_name").isNotNull(), at)).alias("_edge")).select(
        *keys, "_bucket", F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_carry"), F.last("_edge", ignorenulls=True).over(before).alias("_above"))
    named = rows.withColumn("_local", F.count("_name").over(inside)).withColumn("_own", F.last("_name", ignorenulls=True).over(inside)).join(carried, [*keys, "_bucket"]).select(
        *[c for c in rows.columns if c != "_bucket"], (F.col("_local") + F.col("_carry")).alias("section_no"), F.coalesce("_own", "_above").alias("section"))
    declared = F.when(text.rlike(count), F.regexp_extract(text, count, 1).cast("int"))
    sizes = named.withColumn("_d", declared).where("section_no > 0").groupBy(*keys, "section_no", "section").agg(F.max("_d").alias("declared"))
    members = named.where((F.col("section_no") > 0) & F.col("_name").isNull() & ~text.rlike(count)).select(
        *keys, "section_no", "section", F.explode(F.filter(F.split(text, r"\s+", -1), lambda x: x != "")).alias("value"))
    found = members.groupBy(*keys, "section_no").agg(F.count(F.lit(1)).alias("found"))
    checked = sizes.join(found, [*keys, "section_no"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return members, checked.where(F.col("declared") != F.col("found"))


def read_sections(spark: SparkSession, path: str, header: str = r"^(\d)학년$", count: str = r"\((\d+)자\)") -> tuple[DataFrame, DataFrame]:
    return parse_sections(read_lines(spark, path), ["file"], ["block", "seq"], F.col("block"), header, count)


def parse_alternates(df: DataFrame, order: list[str], text: str, exclude: DataFrame | None = None) -> DataFrame:
    """(ord, name, alternate) of comma lists with ``X(Y)`` items: the first occurrence of a name wins."""
    # stripped below the generator (outer: no filter is inferred): filters on the items do not strip them again
    items = df.select(*order, F.posexplode_outer(F.transform(F.split(text, ",", -1), strip)).alias("_i", "_t")).where("_t <> ''")
    pattern = r"^([^(]+)(?:\((.+)\))?$"
    parsed = items.where(F.col("_t").rlike(pattern)).select(
        *order, "_i", strip(F.regexp_extract("_t", pattern, 1)).alias("name"), F.nullif(F.regexp_extract("_t", pattern, 2), F.lit("")).alias("alternate"))
    if exclude is not None:
        parsed = parsed.join(exclude.select("name"), "name", "left_anti").select(*order, "_i", "name", "alternate")
    return first_occurrence(parsed, ["name"], [*order, "_i"])


def multi_gloss(cell: Column) -> Column:
    """Array of glosses in a cell: split at ``|``, cleaned, ``a/b tail`` opened, each once."""

    def clean(s: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(s, r"[()\[\]（）「」]", " "), HANJA, " ")
        return F.trim(F.regexp_replace(F.translate(bare, ",:;", " "), r"\s+", " "))

    def opened(p: Column) -> Column:
        right = F.substring_index(p, " ", -1)
        left = F.substring(p, F.lit(1), F.length(p) - F.length(right) - 1)
        heads = F.filter(F.transform(F.split(left, "/", -1), lambda x: F.trim(x)), lambda x: x != "")
        return F.when(p.contains("/") & p.contains(" "), F.transform(heads, lambda h: F.trim(F.concat_ws(" ", h, right)))).otherwise(F.array(p))

    parts = F.filter(F.transform(F.split(cell, r"\|", -1), clean), lambda p: p != "")
    return F.array_distinct(F.flatten(F.transform(parts, opened)))


def parse_multi_gloss(df: DataFrame, order: list[str], key: str, cell: str) -> DataFrame:
    """(key, ord, gloss): every character of the key cell takes the glosses, each once per character.

    Equal cells are opened once, at their first place, and behind an exchange: the rows of one file
    split would else be multiplied, and sorted for the first occurrence, in its task.
    """
    rows = df.where((strip(F.col(key)) != "") & (strip(F.col(cell)) != ""))
    # one column is compared in a hash table, a struct needs a sort
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    cells = rows.select(F.struct(F.col(key).alias("key"), F.col(cell).alias("cell")).alias("_c"), place.alias("_at")).groupBy("_c").agg(F.min("_at").alias("_at"))
    placed = [F.col("_at").alias(order[0])] if len(order) == 1 else [F.col(f"_at.{c}").alias(c) for c in order]
    opened = cells.select(*placed, F.explode(F.array_distinct(F.regexp_extract_all(strip(F.col("_c.key")), F.lit("(?s:.)"), F.lit(0)))).alias("_k"), F.posexplode(multi_gloss(F.col("_c.cell"))).alias("_i", "gloss"))
    first = first_occurrence(opened, ["_k", "gloss"], [*order, "_i"])
    return first.select(F.col("_k").alias("key"), *order, "_i", "gloss")
