"""Dataset statistics in one pass each, as (name, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import reading_kind

# --- fixed values: tags, bands, checks, levels ---
TAGS = ("s1", "s2", "s3", "s4", "s5", "s6", "j", "h")
BANDS = ("1-1000", "1001-2000", "2001-2809", "TSL")
CHECKS = ("jmdict", "phrase", "unsure")
LEVELS = {"1": "N1", "2": "N2", "3": "N4", "4": "N5"}


def _rows(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    one = df.agg(*[F.coalesce(c.cast("long"), F.lit(0).cast("long")).alias(f"c{i}") for i, c in enumerate(aggregates.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias("value")) for i, n in enumerate(aggregates)])
    return one.select(F.explode(pairs).alias("p")).select("p.name", "p.value")


def _nested_size(c: Column) -> Column:
    return F.aggregate(F.map_values(c), F.lit(0), lambda a, x: a + F.size(x))


def stats_kanji(df: DataFrame) -> DataFrame:
    """``df``: tag, readings and except (maps of arrays), variant (map)."""
    regular, special = F.sum(_nested_size(F.col("readings"))), F.sum(_nested_size(F.col("except")))
    out = {
        "characters": F.count(F.lit(1)), "readings": F.sum(F.size(F.map_keys("readings"))), "examples": regular + special,
        "regular_examples": regular, "variants": F.sum(F.size(F.map_keys("variant"))),
        "exception_readings": F.sum(F.size(F.map_keys("except"))), "exception_examples": special,
    }
    out.update({f"tag {t}": F.count_if(F.col("tag") == t) for t in TAGS})
    return _rows(df, out)


def stats_vocab(df: DataFrame) -> DataFrame:
    """``df``: band, senses (array of struct with checked and example)."""
    def senses(test) -> Column:
        return F.sum(F.size(F.filter("senses", test)))

    out = {"records": F.count(F.lit(1)), "senses": F.sum(F.size("senses")), "examples": senses(lambda s: s["example"].isNotNull()),
           "empty": F.count_if(F.size("senses") == 0)}
    out.update({f"band {b}": F.count_if(F.col("band") == b) for b in BANDS})
    def graded(grade: str) -> Column:
        return senses(lambda s: s["checked"] == grade)

    out.update({f"checked {c}": graded(c) for c in CHECKS})
    return _rows(df, out)


def stats_grammar(df: DataFrame) -> DataFrame:
    """``df``: level, examples (array of struct with ko and mark_method)."""
    def examples(test) -> Column:
        return F.sum(F.size(F.filter("examples", test)))

    out = {"records": F.count(F.lit(1)), "examples": F.sum(F.size("examples")),
           "translated": examples(lambda x: F.coalesce(x["ko"], F.lit("")) != ""),
           "marked": examples(lambda x: F.coalesce(x["mark_method"], F.lit("")) != "")}
    out.update({f"level {label}": F.count_if(F.col("level") == level) for level, label in LEVELS.items()})
    return _rows(df, out)


def reading_groups(df: DataFrame, reading: str) -> DataFrame:
    return df.groupBy(F.coalesce(reading_kind(F.col(reading)), F.lit("invalid")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, flags: dict[str, Column], by: list[str]) -> DataFrame:
    """Share of rows (in millionths, exact integers) for which each flag holds."""
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(n.alias("rows"), *[F.floor(F.count_if(c) * 1000000 / n).alias(name) for name, c in flags.items()])


def histogram(df: DataFrame, value: Column, name: str = "bin") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def summary(stats: DataFrame, overlay: DataFrame, root: DataFrame, known: DataFrame) -> DataFrame:
    """Statistics plus edited count, revision and whether the base moved, all as (name, value) rows.

    ``root`` and ``known`` are the fingerprints (rows, total, mixed) of the base as it is and as it was edited.
    """
    edited = F.count_if(F.to_json("human") != F.to_json("baseline"))
    extra = _rows(overlay, {"edited": edited, "overlay_revision": F.sum("revision")})
    now = F.struct("rows", "total", "mixed")
    both = root.select(F.col("rows").alias("n"), now.alias("now"), F.lit(None).cast("struct<rows:bigint,total:decimal(20,0),mixed:bigint>").alias("was")).union(
        known.select(F.lit(None).cast("long"), F.lit(None).cast("struct<rows:bigint,total:decimal(20,0),mixed:bigint>"), now))
    moved = (F.max("now") != F.max("was")).cast("int")  # one row on each side
    return stats.unionByName(extra).unionByName(_rows(both, {"base_rows": F.max("n"), "overlay_conflict": moved}))
