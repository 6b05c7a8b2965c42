"""Reading alignment: every way a reading can be laid over a surface, as one fold per row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import udtf

from lexframe.functions.text import BASE, SMALL_ALIGN, annotation_ok, kana_fold, let

_NONE = "cast(array() as array<struct<pos:int,text:string>>)"


def alignments(surface: Column, reading: Column, limit: int | None = None) -> Column:
    """Array of annotated strings; empty when nothing fits or the surface is already annotated.

    ``limit`` keeps the first so many placements; without it none is left out.

    Runs of base characters take at least one kana each and never start with a small kana; other
    runs must occur literally in the folded reading.  Partial placements that cannot leave room
    for the rest, or whose next literal does not follow, are dropped at every step.
    """
    none = F.expr("cast(array() as array<string>)")
    unusable = surface.isNull() | reading.isNull() | (surface == "") | (reading == "") | surface.rlike("[()（）]")
    only_kana = F.when(kana_fold(surface) == kana_fold(reading), F.array(surface)).otherwise(none)
    found = F.regexp_extract_all(surface, F.lit(f"[{BASE}]+|[^{BASE}]+"), F.lit(0))
    texts = let(_walk, kana_fold(reading), found, F.transform(found, kana_fold), F.length(surface))
    kept = F.filter(texts if limit is None else F.slice(texts, 1, limit), annotation_ok)
    return F.when(unusable, none).when(~surface.rlike(f"[{BASE}]"), only_kana).otherwise(kept)


def _walk(target: Column, runs: Column, folded: Column, total: Column) -> Column:
    """Array of annotated texts of all complete placements of ``runs`` over ``target``."""

    def piece(start: Column, size: Column) -> Column:
        return F.substring(target, start + 1, size)

    def step(s: Column, run: Column) -> Column:
        n = F.length(run)
        done = s["done"] + n
        rest = total - done
        own, following = F.get(folded, s["i"]), F.coalesce(F.get(folded, s["i"] + 1), F.lit(""))

        def literal(p: Column) -> Column:
            return F.when(piece(p["pos"], n) == own, F.array(
                F.struct((p["pos"] + n).alias("pos"), F.concat(p["text"], run).alias("text")))).otherwise(F.expr(_NONE))

        def based(p: Column) -> Column:
            high = F.length(target) - p["pos"] - rest
            low = F.when(rest == 0, F.greatest(n, high)).otherwise(n)
            sizes = F.when(
                (high >= low) & ~F.contains(F.lit(SMALL_ALIGN), piece(p["pos"], F.lit(1))), F.sequence(low, high)
            ).otherwise(F.expr("cast(array() as array<int>)"))
            fits = F.filter(sizes, lambda k: piece(p["pos"] + k, F.length(following)) == following)
            return F.transform(fits, lambda k: F.struct(
                (p["pos"] + k).alias("pos"),
                F.concat(p["text"], run, F.lit("("), piece(p["pos"], k), F.lit(")")).alias("text")))

        states = F.when(run.rlike(f"^[{BASE}]"), F.flatten(F.transform(s["states"], based))).otherwise(F.flatten(F.transform(s["states"], literal)))
        return F.struct((s["i"] + 1).alias("i"), done.alias("done"), states.alias("states"))

    start = F.expr("named_struct('i', 0, 'done', 0, 'states', array(named_struct('pos', 0, 'text', '')))")
    return F.aggregate(runs, start, step, lambda s: F.transform(
        F.filter(s["states"], lambda p: p["pos"] == F.length(target)), lambda p: p["text"]))


def align_readings(df: DataFrame, keys: list[str], surface: str = "surface", reading: str = "reading", limit: int | None = None) -> DataFrame:
    """(keys, ord, candidate): one row per solution."""
    found = alignments(F.col(surface), F.col(reading), limit)
    return df.select(*keys, F.posexplode(found).alias("ord", "candidate"))


def align_unique(surface: Column, reading: Column) -> Column:
    """The only solution, or null when there is none or more than one."""
    found = alignments(surface, reading, 2)
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


@udtf(returnType="ord: int, candidate: string")
class AlignTable:
    """Row-by-row table function for ad-hoc SQL; ``alignments`` is the form for whole tables."""

    def eval(self, surface: str, reading: str) -> Iterator[tuple[int, str]]:
        import re

        if not surface or not reading or re.search("[()（）]", surface):
            return
        fold = {c: c - 0x60 for c in range(0x30A1, 0x30F7)}
        target, base = reading.translate(fold), "[⺀-⻿㐀-䶿一-鿿豈-\ufaff\U00020000-\U0002ffff々〆]"
        runs = re.findall(f"{base}+|(?:(?!{base}).)+", surface)
        # partial placements (kana used, text so far), run by run; those whose next literal does not follow are dropped
        states, left = [(0, "")], len(surface)
        for i, run in enumerate(runs):
            left -= len(run)
            following = runs[i + 1].translate(fold) if i + 1 < len(runs) else ""
            grown = []
            for at, text in states:
                if not re.match(base, run):
                    if target.startswith(run.translate(fold), at):
                        grown.append((at + len(run), text + run))
                    continue
                most = len(target) - at - left
                for size in range(len(run) if left else max(len(run), most), most + 1):
                    part = target[at : at + size]
                    if part[0] not in SMALL_ALIGN and re.fullmatch("[ぁ-ゟァ-ヺー]+", part) and target.startswith(following, at + size):
                        grown.append((at + size, f"{text}{run}({part})"))
            states = grown
        yield from enumerate(text for at, text in states if at == len(target))


def register_sql(spark: SparkSession) -> None:
    """``SELECT * FROM t, LATERAL align(t.surface, t.reading)``."""
    spark.udtf.register("align", AlignTable)
