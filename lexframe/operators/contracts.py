"""Record contracts of the three dataset shapes: one row (key, rule, path) per violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import (
    MAX_SENSES, PARTS_OF_SPEECH, annotation_ok, full_reading, has_boundary_semicolon, let, mark_in_chunk, reading_kind, reading_matches, senses, strip,
)
from lexframe.operators.stats import BANDS, CHECKS, TAGS

# --- fixed values: labels and field sets ---
VARIANT_LABELS = ("康熙字典体", "簡易慣用字体", "許容字体", "印刷標準字体（表外漢字字体表）")
NOTE_FIELDS = {
    "special_reading": ("of", "word", "reading"), "also_read": ("of", "word", "reading"), "also_reading": ("of", "reading"),
    "also_written": ("of", "word", "written"), "same_kun": ("of", "words"), "text": ("of", "body"),
}
MAIN_FORM = "본"
LISTS = ("ngsl", "tsl")


def _fail(cond: Column, rule: str, path: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(rule).alias("rule"), path.cast("string").alias("path")))


def _gather(*rules: Column) -> Column:
    return F.array_compact(F.array(*rules))


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def _path(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _example(x: Column, spot: Column, required: Column | None) -> Column:
    rules = []
    for field in ("w", "ko"):
        rules += [_fail(_blank(x[field]), f"empty {field}", spot), _fail(~_blank(x[field]) & (x[field] != strip(x[field])), f"untrimmed {field}", spot)]
    lines = F.split(x["ko"], "\n", -1)
    rules += [
        _fail(F.size(senses(x["ko"])) > MAX_SENSES, "too many senses", spot),
        _fail(~_blank(x["ko"]) & F.exists(lines, lambda v: (v != strip(v)) | (v == "")), "blank or untrimmed sense", spot),
        _fail(has_boundary_semicolon(x["ko"]), "semicolon between senses", spot),
        _fail(x["w"].isNotNull() & ~annotation_ok(x["w"]), "annotation does not parse", spot),
    ]
    if required is not None:
        rules.append(_fail(annotation_ok(x["w"]) & ~reading_matches(full_reading(x["w"]), required), "exception reading not contained", spot))
    return _gather(*rules)


def _bucket(name: str, bad_key, required: bool) -> Column:
    def entry(e: Column) -> Column:
        spot = _path(f"{name}.", e["key"])
        own = _gather(_fail(bad_key(e["key"]), f"{name} key", spot), _fail(e["value"].isNull() | (F.size(e["value"]) == 0), f"{name} without examples", spot))
        inner = F.flatten(F.transform(F.coalesce(e["value"], F.expr("cast(array() as array<struct<w:string,ko:string>>)")), lambda x, i: _example(
            x, _path(f"{name}.", e["key"], "[", i, "]"), e["key"] if required else None)))
        return F.concat(own, inner)

    return F.flatten(F.transform(F.map_entries(name), entry))


def _notes() -> Column:
    def note(n: Column, i: Column) -> Column:
        spot = _path("note[", i, "]")
        rules = [_fail(n["kind"].isNull() | ~n["kind"].isin(*NOTE_FIELDS), "unknown note kind", spot)]
        for field in ("of", "word", "reading", "written", "words", "body"):
            wanted = n["kind"].isin(*[k for k, fields in NOTE_FIELDS.items() if field in fields])
            empty = (F.size(n[field]) < 1) | F.exists(n[field], _blank) if field == "words" else strip(n[field]) == ""
            rules += [
                _fail(wanted & n[field].isNull(), f"note field missing: {field}", spot),
                _fail(n["kind"].isin(*NOTE_FIELDS) & ~wanted & n[field].isNotNull(), f"note field not allowed: {field}", spot),
                _fail(n[field].isNotNull() & empty, f"note field empty: {field}", spot),
            ]
        return _gather(*rules)

    empty = _gather(_fail(F.col("note").isNotNull() & (F.size("note") == 0), "empty note list", F.lit("note")))
    return F.concat(empty, F.coalesce(F.flatten(F.transform("note", note)), F.expr("cast(array() as array<struct<rule:string,path:string>>)")))


def _korean() -> Column:
    forms = F.map_keys("variant")

    def entry(e: Column) -> Column:
        spot, other = _path("korean.", e["key"]), e["key"] != MAIN_FORM
        own = _gather(
            _fail(other & ((F.length(e["key"]) != 1) | ~F.array_contains(forms, e["key"])), "gloss form not a variant", spot),
            _fail(other & (F.size(e["value"]) == 0), "empty gloss form", spot))
        inner = F.flatten(F.transform(e["value"], lambda v, i: _gather(
            _fail(_blank(v), "empty gloss", spot), _fail(~_blank(v) & (v != strip(v)), "untrimmed gloss", spot))))
        return F.concat(own, inner)

    total = F.aggregate(F.map_values("korean"), F.lit(0), lambda a, v: a + F.size(v))
    head = _gather(_fail(~F.map_contains_key("korean", F.lit(MAIN_FORM)), "no main gloss form", F.lit("korean")), _fail(total == 0, "no gloss at all", F.lit("korean")))
    return F.concat(head, F.flatten(F.transform(F.map_entries("korean"), entry)))


def _emit(df: DataFrame, found: Column) -> DataFrame:
    return df.select("key", F.posexplode_outer(found).alias("_i", "_v")).where("_i is not null").select("key", "_v.rule", "_v.path")


def validate_kanji(df: DataFrame) -> DataFrame:
    """``df``: key, tag, variant, except, readings, korean, korean_src, note."""
    none = F.expr("cast(array() as array<struct<rule:string,path:string>>)")
    missing = _gather(*[_fail(F.col(c).isNull(), f"missing field: {c}", F.lit(c)) for c in ("tag", "variant", "except", "readings", "korean")])
    variants = F.flatten(F.transform(F.map_entries("variant"), lambda e: _gather(
        _fail(F.length(e["key"]) != 1, "variant not one character", _path("variant.", e["key"])),
        _fail(e["value"].isNull() | ~e["value"].isin(*VARIANT_LABELS), "unknown variant label", _path("variant.", e["key"])))))
    single = _gather(
        _fail(~F.col("tag").isin(*TAGS), "unknown tag", F.lit("tag")), _fail(F.size(F.map_keys("readings")) == 0, "no readings", F.lit("readings")),
        _fail(F.col("korean_src").isNotNull() & (F.col("korean_src") != "gemini"), "unknown gloss source", F.lit("korean_src")))
    hiragana = lambda k: ~k.rlike(r"^[\x{3041}-\x{309F}]+$")
    full = F.concat(single, variants, _bucket("except", hiragana, True), _bucket("readings", lambda k: reading_kind(k).isNull(), False), _notes(), _korean())
    found = F.when(F.length("key") != 1, _gather(_fail(F.lit(True), "key not one character", F.lit("key")))).otherwise(
        let(lambda m: F.when(F.size(m) > 0, m).otherwise(F.coalesce(full, none)), missing))
    return _emit(df, found)


def validate_grammar(df: DataFrame) -> DataFrame:
    """``df``: key, head, level, gloss_ko, examples (ja, marked, ko, mark_method)."""
    def example(x: Column, i: Column) -> Column:
        spot, marked, ja = _path("examples[", i, "]"), F.coalesce(x["marked"], F.lit("")), F.coalesce(x["ja"], F.lit(""))
        marks = F.length(F.regexp_replace(marked, "[^*]", ""))
        whole = F.regexp_replace(marked, r"\*", "") == ja
        return _gather(
            _fail(ja == "", "empty example", spot), _fail(marks % 2 == 1, "unpaired marks", spot), _fail((marked != "") & ~whole, "text changes without marks", spot),
            _fail((marked != "") & whole & (marks >= 2) & mark_in_chunk(marked), "mark inside a chunk", spot))

    missing = _gather(*[_fail(F.col(c).isNull(), f"missing field: {c}", F.lit(c)) for c in ("head", "level", "gloss_ko", "examples")])
    return _emit(df, F.concat(missing, F.coalesce(F.flatten(F.transform("examples", example)), F.expr("cast(array() as array<struct<rule:string,path:string>>)"))))


def written_ok(ja: Column) -> Column:
    """A whole annotation, or none at all."""
    return ~ja.rlike("[()]") | annotation_ok(ja)


def validate_vocab(df: DataFrame) -> DataFrame:
    """``df``: key, list, rank, band, family, senses (ja, pos, gloss, en, checked, example (en, ja))."""
    def sense(s: Column, i: Column) -> Column:
        spot, e = _path("senses[", i, "]"), s["example"]
        absent = [_fail(s[f].isNull(), f"missing field: {f}", spot) for f in ("ja", "pos", "gloss", "en", "checked")]
        return _gather(
            *absent, _fail(F.coalesce(s["ja"], F.lit("")) == "", "empty surface", spot), _fail((s["ja"] != "") & ~written_ok(s["ja"]), "annotation incomplete", spot),
            _fail(~s["pos"].isin(*PARTS_OF_SPEECH), "unknown class", spot), _fail(~s["checked"].isin(*CHECKS), "unknown grade", spot),
            _fail(e.isNotNull() & (F.coalesce(e["en"], F.lit("")) == ""), "example without English", spot),
            _fail(e.isNotNull() & (F.coalesce(e["ja"], F.lit("")) == ""), "example without Japanese", spot),
            _fail(e.isNotNull() & (e["ja"] != "") & ~written_ok(e["ja"]), "example annotation incomplete", spot))

    head = _gather(
        *[_fail(F.col(c).isNull(), f"missing field: {c}", F.lit(c)) for c in ("list", "rank", "band", "family", "senses")],
        _fail(F.col("rank") < 1, "rank below one", F.lit("rank")), _fail(~F.col("list").isin(*LISTS), "unknown list", F.lit("list")),
        _fail(~F.col("band").isin(*BANDS), "unknown band", F.lit("band")), _fail(F.size("family") == 0, "empty family", F.lit("family")))
    return _emit(df, F.concat(head, F.coalesce(F.flatten(F.transform("senses", sense)), F.expr("cast(array() as array<struct<rule:string,path:string>>)"))))
