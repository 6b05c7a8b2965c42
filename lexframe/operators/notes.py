"""Note columns: cleaning, example mining and ordered classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import after, kana_fold, let, strip

# --- fixed values: patterns of the note language ---
_K = r"㐀-鿿"
_OUTSIDE = r"，,、。「」⇔（）()\s"
#: a run with a character and its reading; taken from its start (or the last match) and as a whole, so it is read once
REFERENCE = f"(?:(?<![^{_OUTSIDE}])|\\G)[^{_OUTSIDE}{_K}]*+[{_K}][^{_OUTSIDE}]*+（[ぁ-ゟ]+）[ぁ-ゟァ-ヿ県府都]*"
PREFECTURE = f"([{_K}]+)（([ぁ-ゟ]+)）[県府都]"
GLYPH_NOTE = "＊?［[^］]*］(?:＝許容字体)?"
NOT_EXAMPLE = "^⇔|^＊|^\\*|^［|^\\]|参照|とも。|とも言う|とも書く|などは|は，|は、|と言う|^○○|^……|。$"
_ANY = r"\x{3400}-\x{9FFF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}"
_LIST = "「[^」]+」(?:[，,]「[^」]+」)*"
ALSO_READING = "^「([^」]+)」とも。$"
ALSO_READ = f"^({_LIST})(?:など)?は，({_LIST})とも。$"
SPECIAL = f"^({_LIST})(?:など)?は，({_LIST})。$"
ALSO_WRITTEN = f"^({_LIST})(?:など)?は，({_LIST})とも書く。$"
ONE_WRITTEN = "^「([^」]+)」とも書く。$"
READ_ALSO = "^「([^」]+)」は，「([^」]+)」と読むこともある。$"
KNOWN_TEXT = (
    "「羽（は）」は，前に来る音によって「わ」，「ば」，「ぱ」になる。",
    "「把（ハ）」は，前に来る音によって「ワ」，「バ」，「パ」になる。",
    "「宮内庁」などと使う。",
    "「京浜」，「京阪」などと使う。",
    "「猟」の字音の転用。",
    "「モウ」は，慣用音。",
    "「兄弟」は，「ケイテイ」と読むこともある。",
    "「身上」は，「シンショウ」と「シンジョウ」とで，意味が違う。",
    "「山頂」の意。",
    "多く文語の「亡き」で使う。",
    "「憂き」は，文語の連体形。",
)


def strip_references(c: Column) -> Column:
    return F.regexp_replace(c, REFERENCE, "")


def prefecture_pairs(df: DataFrame, note: str) -> DataFrame:
    """(surface, reading) of every name printed with its reading."""
    found = F.regexp_extract_all(F.col(note), F.lit(PREFECTURE), F.lit(0))
    pair = F.col("p")
    return df.select(F.explode(found).alias("p")).select(
        F.regexp_extract(pair, PREFECTURE, 1).alias("surface"), F.regexp_extract(pair, PREFECTURE, 2).alias("reading")).distinct()


def parse_references(df: DataFrame, page: list[str], line: str, text: str) -> DataFrame:
    """(page, entry, reading, ord, surface): a kana line opens an entry, lines with characters belong to it."""
    from pyspark.sql import Window


    def line_of(s: Column) -> Column:
        t = F.regexp_replace(F.replace(s, F.lit("　"), F.lit("")), "（[^）]*）", "")
        return F.struct(s.rlike("^(?:付表|※|例|「)").alias("_aside"), t.alias("t"))

    # out of a generator, so that the filter is not pushed below it and the line not worked out once more
    seen = df.select(*page, line, F.inline_outer(F.array(let(line_of, strip(F.col(text))))))
    rows = seen.where(~F.col("_aside") & (F.col("t") != "")).drop("_aside")
    w = Window.partitionBy(*page).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    kana = F.col("t").rlike("^[ぁ-ゟ]+$")
    opened = rows.withColumn("entry", F.sum(kana.cast("int")).over(w)).withColumn(
        "reading", F.last(F.when(kana, F.col("t")), ignorenulls=True).over(w))
    base = opened.where(F.col("t").rlike(f"[{_ANY}]") & (F.col("entry") > 0))
    inside = Window.partitionBy(*page, "entry").orderBy(line)
    return base.select(*page, "entry", "reading", (F.row_number().over(inside) - 1).alias("ord"), F.col("t").alias("surface"))


def mined_examples(note: Column) -> Column:
    """Array of examples hidden in a note column."""

    def clean(s: Column) -> Column:
        bare = F.when(s.startswith("「"), F.regexp_replace(s, "^「+|「+$", "")).otherwise(s)
        both = F.when(s.startswith("「") & s.endswith("」"), F.regexp_replace(s, "^[「」]+|[「」]+$", "")).otherwise(bare)
        return strip(F.substring_index(both, "⇔", 1))

    def mined(n: Column) -> Column:
        quoted = F.regexp_extract_all(n, F.lit("「([^」]+)」"), F.lit(1))
        pieces = F.split(n, f"(?<=）)(?=[{_ANY}「])(?=[^（]*（)", -1)
        kept = F.filter(F.transform(F.transform(pieces, strip), clean), lambda t: t.rlike(f"[{_ANY}]") & ~t.rlike(NOT_EXAMPLE))
        split = F.filter(F.transform(F.flatten(F.transform(kept, lambda t: F.split(t, "，", -1))), strip), lambda x: x != "")
        return F.when(n == "", F.expr("cast(array() as array<string>)")).when(n.contains("などと使う"), quoted).otherwise(split)

    return let(mined, strip(strip_references(note)))


def note_body(note: Column) -> Column:
    """The part before the arrow, without glyph notes and, outside quotes, without references."""
    head = F.regexp_replace(F.substring_index(note, "⇔", 1), GLYPH_NOTE, "")
    parts = F.regexp_extract_all(head, F.lit("「[^」]*」|(?:(?!「[^」]*」)(?s:.))+"), F.lit(0))
    kept = F.transform(parts, lambda p: F.when(p.rlike("^「[^」]*」$"), p).otherwise(strip_references(p)))
    joined = strip(F.array_join(kept, ""))
    return strip(F.regexp_replace(joined, "^[，,、]+|[，,、]+$", ""))


def classify_notes(df: DataFrame, keys: list[str], ch: str, reading: str, note: str) -> DataFrame:
    """(keys, kind, of, word, reading, written, words, body): typed rows; kind ``reject`` when unknown.

    The first pattern that matches decides; paired lists are zipped, one word may carry several
    readings, and lists of different lengths are rejected unless the whole text is a known one.
    """
    raw = strip(F.coalesce(F.col(note), F.lit("")))
    arrow = F.when(raw.contains("⇔"), after(raw, F.call_function("locate", F.lit("⇔"), raw) + 1)).otherwise("")
    others = F.filter(F.transform(F.split(arrow, "[，,、]", -1), strip), lambda x: x != "")
    item = "struct<kind:string,word:string,reading:string,written:string,words:array<string>,body:string>"
    null = F.lit(None).cast("string")

    def entry(kind: str, word=None, sound=None, written=None, words=None, body=None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), (null if word is None else word).alias("word"), (null if sound is None else sound).alias("reading"),
            (null if written is None else written).alias("written"),
            (F.lit(None).cast("array<string>") if words is None else words).alias("words"), (null if body is None else body).alias("body"))

    body = F.col("_body")
    names = F.filter(F.transform(F.split(body, "[，,]", -1), strip), lambda x: x != "")
    listing = (F.size(names) > 0) & F.forall(names, lambda x: x.rlike(r"^[㐀-鿿豈-\x{FAFF}々〆]+[県府都]?$"))

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(body, pattern, i)

    def quotes(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit("「([^」]+)」"), F.lit(1))

    def paired(pattern: str, kind: str, field: str) -> Column:
        words = F.transform(quotes(group(pattern, 1)), lambda w: strip(F.regexp_replace(w, "（[^）]*）", "")))
        values = quotes(group(pattern, 2))

        def one(w: Column, v: Column) -> Column:
            return entry(kind, word=w, sound=v if field == "reading" else None, written=v if field == "written" else None)

        def zipped(ws: Column, vs: Column) -> Column:
            return F.when(F.size(ws) == 1, F.transform(vs, lambda v: one(F.get(ws, F.lit(0)), v))).when(
                F.size(ws) == F.size(vs), F.transform(ws, lambda w, i: one(w, F.get(vs, i))))

        return let(zipped, words, values)

    empty = F.expr(f"cast(array() as array<{item}>)")
    known = F.when(body.isin(*KNOWN_TEXT), F.array(entry("text", body=body))).otherwise(F.array(entry("reject", body=raw)))
    found = (
        F.when((body == "") | listing, empty)
        .when(body.rlike(ALSO_READING), F.array(entry("also_reading", sound=group(ALSO_READING, 1))))
        .when(body.rlike(ALSO_READ), F.coalesce(paired(ALSO_READ, "also_read", "reading"), known))
        .when(body.rlike(SPECIAL), F.coalesce(paired(SPECIAL, "special_reading", "reading"), known))
        .when(body.rlike(ALSO_WRITTEN), F.coalesce(paired(ALSO_WRITTEN, "also_written", "written"), known))
        .when(body.rlike(ONE_WRITTEN), F.array(entry("also_written", word=F.col(ch), written=group(ONE_WRITTEN, 1))))
        .when(body.rlike(READ_ALSO), F.array(entry("also_read", word=group(READ_ALSO, 1), sound=group(READ_ALSO, 2))))
        .otherwise(known)
    )
    same = F.when(F.size(others) > 0, F.array(entry("same_kun", words=others))).otherwise(empty)
    rows = df.withColumn("_body", note_body(raw)).withColumn("_found", F.concat(same, found))
    of = strip(F.coalesce(F.col(reading), F.lit("")))
    # outer, so that no filter on the classified array is inferred and evaluated once more below
    return rows.select(*keys, of.alias("of"), F.posexplode_outer("_found").alias("ord", "_e")).where("ord is not null").select(
        *keys, "ord", "_e.kind", "of", "_e.word", "_e.reading", "_e.written", "_e.words", "_e.body")


def route_notes(classified: DataFrame, ch: str = "ch") -> tuple[DataFrame, DataFrame]:
    """(notes, exceptions): special readings become exceptions keyed by the folded whole-word reading."""
    special = F.col("kind") == "special_reading"
    exceptions = classified.where(special).select(ch, kana_fold(F.col("reading")).alias("reading"), "word").distinct()
    return classified.where(~special & (F.col("kind") != "reject")), exceptions
