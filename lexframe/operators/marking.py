"""Marking where a pattern is realised in an annotated sentence, and auditing such marks.

Patterns become regex columns, placements one fold per row; the lexicon is joined by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import (
    H_HEADS, P_HEADS, PLAIN_HEADS, VOICED_HEADS, chunks, let, mark_in_chunk, mark_spans, plain_surface, plane, strip,
)
from lexframe.operators.verify import HEAD, head_index
from lexframe.session import checkpointed

# --- fixed values: gaps, slack, inflections, connection shapes ---
MAX_GAP = 14
SLACK = 4
VOICED_FROM = 2
LEFT_BREAK = "[。、．，！？「『（(　 ]"
STEM_CHANGING = {
    "する": ("しなかった", "しました", "しません", "しないで", "しよう", "しない", "します", "して", "した", "すれ", "する", "し"),
    "くる": ("こなかった", "きました", "きません", "こない", "きます", "きて", "きた", "くる", "き"),
}
BARE_ONLY = {
    "ない": ("ありません", "なかった", "なければ", "なくて", "ません", "ない", "なく", "なき"),
    "だ": ("でした", "だった", "である", "です", "だ"),
}
STEM_ENDING = "[るうだいなくきしてた]$"
TAIL_KANA = "[ぁ-ゟー]{0,4}"
SLOT = "(?:する動詞の[ＮN][のをに]?|普通形|丁寧形|数量|値段|[ＶV]|[ＮN]|イ[ＡA]|ナ[ＡA])"
CHAIN_BREAK = r"(?<=\S)\s+(?=(?:する動詞の[ＮN]|普通形|丁寧形|数量|値段|[ＶVＮN]|イ[ＡA]|ナ[ＡA]))"
CONJUGATIONS = ("", "る", "ます", "た", "ない", "よう", "ば")
ATTACHES = "[ＶVＮNイナ]|普通形|丁寧形|数量|値段"
MAX_CHAINS = 8
OPTIONAL = "[（(][^）)]*[）)]"

#: words of a lexicon that are broadcast
BROADCAST_ROWS = 500_000

_STRINGS = "cast(array() as array<string>)"
_SPANS = "cast(array() as array<struct<s:int,e:int>>)"


# --- N27, N28 ---
def _core(segments: Column) -> Column:
    """Body of a repeated pattern: the last segment without its verb, when it also stands before."""
    last = F.element_at(segments, -1)
    core = F.substring(last, F.lit(1), F.length(last) - 2)
    before = F.slice(segments, F.lit(1), F.size(segments) - 1)
    return F.when((F.size(segments) >= 2) & last.rlike("(?:する|くる)$") & (core != "") & F.array_contains(before, core), core)


def head_forms(head: Column) -> Column:
    """Array of forms, each an array of literal segments; shortened repetitions come last."""
    parts = F.array_distinct(F.filter(F.split(strip(F.coalesce(head, F.lit(""))), "[・/｜|]", -1), lambda p: p != ""))
    forms = F.transform(parts, lambda p: F.filter(
        F.split(p, "[～〜]", -1), lambda x: (x != "") & (strip(F.regexp_replace(x, OPTIONAL, "")) != "")))

    def shortened(fs: Column) -> Column:
        repeats = F.transform(F.filter(fs, lambda f: _core(f).isNotNull()), lambda f: F.slice(f, -1, 1))
        return F.array_distinct(F.concat(fs, repeats))

    return let(shortened, F.filter(forms, lambda f: F.size(f) > 0))


def connect_forms(connect: Column, known: Column) -> Column:
    """Literal alternative forms of connection shapes, without the known ones."""

    def tail(option: Column) -> Column:
        bare = strip(F.regexp_replace(strip(option), f"^{SLOT}", ""))
        return F.when(bare.isin(*CONJUGATIONS), "").otherwise(F.regexp_replace(bare, "^る(?=.)", ""))

    def chain(slots: Column) -> Column:
        return F.aggregate(slots, F.array(F.lit("")), lambda acc, slot: let(
            lambda opts: F.slice(F.flatten(F.transform(acc, lambda a: F.transform(opts, lambda o: F.concat(a, o)))), 1, MAX_CHAINS),
            F.sort_array(F.array_distinct(F.transform(F.split(slot, "[／/・]", -1), tail)))))

    def shapes(shape: Column) -> Column:
        pieces = F.split(F.regexp_replace(shape, OPTIONAL, ""), "＋", -1)
        marked = F.array_join(F.transform(pieces, lambda p: F.regexp_replace(strip(p), CHAIN_BREAK, "\u0001")), "\u0002")
        return F.flatten(F.transform(F.split(marked, "\u0001", -1), lambda c: chain(F.split(c, "\u0002", -1))))

    texts = F.flatten(F.transform(F.coalesce(connect, F.expr(_STRINGS)), shapes))
    long = F.filter(texts, lambda f: F.length(F.translate(f, "～〜", "")) >= 2)
    segments = F.transform(long, lambda f: F.filter(F.split(f, "[～〜]", -1), lambda x: x != ""))
    return let(lambda segs, old: F.array_distinct(F.filter(segs, lambda s: (F.size(s) > 0) & ~F.array_contains(old, s))), segments, known)


# --- patterns ---
def _quote(c: Column) -> Column:
    return F.concat(F.lit("\\Q"), c, F.lit("\\E"))


def literal_pattern(segment: Column, voiced: Column) -> Column:
    """Regex of a literal segment: bracketed parts optional, the first character voiced when asked."""

    def build(tokens: Column) -> Column:
        first = F.array_position(F.transform(tokens, lambda t: F.length(t) == 1), True) - 1

        def one(t: Column, i: Column) -> Column:
            options = F.array_distinct(F.array(t, F.translate(t, PLAIN_HEADS, VOICED_HEADS), F.translate(t, H_HEADS, P_HEADS)))
            widened = F.concat(F.lit("(?:"), F.array_join(F.transform(options, _quote), "|"), F.lit(")"))
            optional = F.concat(F.lit("(?:"), _quote(F.substring(t, F.lit(2), F.length(t) - 2)), F.lit(")?"))
            return F.when(F.length(t) > 1, optional).when((i == first) & voiced, widened).otherwise(_quote(t))

        return F.array_join(F.transform(tokens, one), "")

    return let(build, F.regexp_extract_all(segment, F.lit(r"（[^）]*）|\([^)]*\)|(?s:.)"), F.lit(0)))


def _options(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(sorted(words, key=len, reverse=True)) + ")"


def inflected_pattern(segment: Column) -> Column:
    """Regex of the inflected last segment, or null when none can be made."""
    out = None
    for word, forms in BARE_ONLY.items():
        out = F.when(segment == word, F.lit(_options(forms))) if out is None else out.when(segment == word, F.lit(_options(forms)))
    for verb, forms in STEM_CHANGING.items():
        prefix = F.substring(segment, F.lit(1), F.length(segment) - len(verb))
        out = out.when(segment.endswith(verb), F.concat(literal_pattern(prefix, F.length(prefix) >= VOICED_FROM), F.lit(_options(forms))))
    stem = F.regexp_replace(segment, STEM_ENDING, "")
    usable = (stem != segment) & (F.length(stem) >= 2)
    return out.when(usable, F.concat(literal_pattern(stem, F.lit(True)), F.lit(TAIL_KANA)))


def attempts(forms: Column, prefix: str) -> Column:
    """Array of (method, patterns): every form as it is, inflected, and as a repetition, in this order."""

    def of(segments: Column) -> Column:
        exact = F.transform(segments, lambda s: literal_pattern(s, F.length(s) >= VOICED_FROM))
        front = lambda p: F.slice(p, F.lit(1), F.size(p) - 1)
        tail, core = inflected_pattern(F.element_at(segments, -1)), _core(segments)
        body = literal_pattern(core, F.length(core) >= VOICED_FROM)

        def listed(p: Column) -> Column:
            def item(method: str, patterns: Column) -> Column:
                return F.struct(F.lit(prefix + method).alias("method"), patterns.alias("patterns"))

            return F.array_compact(F.array(
                item("exact", p), F.when(tail.isNotNull(), item("inflected", F.concat(front(p), F.array(tail)))),
                F.when(core.isNotNull(), item("repeat", F.concat(front(p), F.array(body))))))

        return let(listed, exact)

    return F.flatten(F.transform(forms, of))


def needs_left(connect: Column) -> Column:
    return F.exists(F.coalesce(connect, F.expr(_STRINGS)), lambda s: F.substring_index(s, "＋", 1).rlike(ATTACHES))


# --- placement ---
def placements(surface: Column, patterns: Column) -> Column:
    """All ways to place the patterns in order, at most MAX_GAP characters apart; arrays of (s, e)."""
    n = F.length(surface)

    def hits(pattern: Column, low: Column, high: Column) -> Column:
        spots = F.transform(F.sequence(low, high), lambda p: F.struct(
            p.alias("s"), (p + F.length(F.call_function("regexp_extract", F.substring(surface, p + 1, n), F.concat(F.lit("^(?:"), pattern, F.lit(")")), F.lit(0)))).alias("e")))
        return F.filter(spots, lambda x: x["e"] > x["s"])

    def step(states: Column, pattern: Column) -> Column:
        def grow(spans: Column) -> Column:
            low = F.when(F.size(spans) == 0, F.lit(0)).otherwise(F.element_at(spans, -1)["e"])
            high = F.when(F.size(spans) == 0, n).otherwise(F.least(n, low + MAX_GAP))
            return F.transform(hits(pattern, low, high), lambda x: F.array_append(spans, x))

        return F.when(F.regexp_like(surface, pattern), F.flatten(F.transform(states, grow))).otherwise(F.filter(states, lambda x: F.lit(False)))

    return F.aggregate(patterns, F.array(F.expr(_SPANS)), step)


def best_placement(surface: Column, found: Column, spots: Column, left: Column) -> Column:
    """The placement cutting fewest lexicon words, then with left context, narrow gaps, furthest left."""

    def scored(spans: Column, i: Column) -> Column:
        def cut(x: Column) -> Column:
            return F.exists(spots, lambda w: (w["s"] <= x["s"]) & (x["e"] <= w["e"]) & ((w["s"] < x["s"]) | (x["e"] < w["e"])))

        start = F.get(spans, F.lit(0))["s"]
        alone = (start == 0) | F.substring(surface, start, F.lit(1)).rlike(LEFT_BREAK)
        gaps = F.aggregate(spans, F.struct(F.lit(-1).alias("e"), F.lit(0).alias("g")), lambda a, x: F.struct(
            x["e"].alias("e"), (a["g"] + F.when(a["e"] >= 0, x["s"] - a["e"]).otherwise(0)).alias("g")), lambda a: a["g"])
        return F.struct(F.size(F.filter(spans, cut)).alias("cut"), (left & alone).alias("alone"), gaps.alias("gap"), start.alias("start"), i.alias("i"), spans.alias("spans"))

    return F.array_min(F.transform(found, scored))["spans"]


def snap_spans(annotated: Column, spans: Column, which: Column | str) -> Column:
    """Plane spans to annotated spans: widened to whole chunks, touching ones merged."""
    sound = F.lit(which) == "sound" if isinstance(which, str) else which == "sound"

    def move(groups: Column) -> Column:
        owners = F.flatten(F.transform(groups, lambda g: F.array_repeat(
            F.struct(g["start"].alias("s"), g["stop"].alias("e")), F.length(F.when(sound, g["sound"]).otherwise(g["surface"])))))

        def step(acc: Column, x: Column, own: Column) -> Column:
            b, f = F.get(own, x["s"])["s"], F.get(own, x["e"] - 1)["e"]
            last = F.element_at(acc, -1)
            joined = F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), F.struct(last["s"].alias("s"), F.greatest(last["e"], f).alias("e")))
            return F.when((F.size(acc) > 0) & (b <= F.try_element_at(acc, F.lit(-1))["e"]), joined).otherwise(F.array_append(acc, F.struct(b.alias("s"), f.alias("e"))))

        return let(lambda own: F.aggregate(spans, F.expr(_SPANS), lambda acc, x: step(acc, x, own)), owners)

    return let(move, chunks(annotated))


def apply_marks(annotated: Column, spans: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        return F.struct(x["e"].alias("at"), F.concat(
            s["out"], F.substring(annotated, s["at"] + 1, x["s"] - s["at"]), F.lit("*"),
            F.substring(annotated, x["s"] + 1, x["e"] - x["s"]), F.lit("*")).alias("out"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(annotated, s["at"] + 1, F.length(annotated))))


_FOUND = "cast(null as struct<method:string,plane:string,spans:array<struct<s:int,e:int>>>)"


def find_spans(annotated: Column, tries: Column, left: Column, spots_surface: Column, spots_sound: Column) -> Column:
    """First attempt with any placement, surface plane before sound plane: (method, plane, spans) or null.

    Later attempts are not evaluated once one has matched; scores only rank placements inside it.
    """

    def search(surface: Column, sound: Column) -> Column:
        def on(which: str, text: Column, spots: Column, t: Column) -> Column:
            def pick(found: Column) -> Column:
                return F.when(F.size(found) > 0, F.struct(
                    F.concat(t["method"], F.lit("/plain" if which == "surface" else "/reading")).alias("method"), F.lit(which).alias("plane"),
                    best_placement(text, found, spots, left).alias("spans")))

            return let(pick, placements(text, t["patterns"]))

        return F.aggregate(tries, F.expr(_FOUND), lambda acc, t: F.when(acc.isNotNull(), acc).otherwise(
            F.coalesce(on("surface", surface, spots_surface, t), on("sound", sound, spots_sound, t))))

    return let(search, plane(annotated, "surface"), plane(annotated, "sound"))


def with_spots(df: DataFrame, keys: list[str], annotated: str, lexicon: DataFrame) -> DataFrame:
    """Adds spots_surface and spots_sound: lexicon words standing in the two planes.

    ``lexicon``: word, plane (written or spoken).  The surface plane knows both kinds.
    """
    planes = F.array(*[F.struct(F.lit(sound).alias("sound"), plane(F.col(annotated), name).alias("text")) for sound, name in ((False, "surface"), (True, "sound"))])
    words = checkpointed(lexicon.groupBy(F.col("word").alias("_w")).agg(F.max(F.col("plane") == "spoken").alias("_spoken")))
    # the places of all words are many times the rows: no exchange for them while the lexicon is below the bound
    near = F.broadcast if words.count() <= BROADCAST_ROWS else (lambda x: x)
    n, s = F.length("text"), F.col("s")
    starts = df.select(*keys, F.inline(planes)).where(n >= HEAD).select(*keys, "sound", "text", F.explode(F.sequence(F.lit(0), n - HEAD)).alias("s"))
    heads = starts.withColumn("_head", F.substring("text", s + 1, F.lit(HEAD))).join(near(head_index(words.select(F.col("_w").alias("word")))), "_head")
    opened = heads.select(*keys, "sound", "s", "text", F.explode("_sizes").alias("_n")).where(F.col("_n") <= n - s)
    met = opened.select(*keys, "sound", "s", (s + F.col("_n")).alias("e"), F.substring("text", s + 1, F.col("_n")).alias("_w")).join(near(words), "_w").where(~F.col("sound") | F.col("_spoken"))
    spot = F.struct("s", "e")
    spots = met.groupBy(*keys).agg(
        F.collect_list(F.when(~F.col("sound"), spot)).alias("spots_surface"), F.collect_list(F.when(F.col("sound"), spot)).alias("spots_sound"))
    none = F.expr(_SPANS)
    joined = df.join(spots, keys, "left")
    return joined.withColumn("spots_surface", F.coalesce("spots_surface", none)).withColumn("spots_sound", F.coalesce("spots_sound", none))


def _marked(df: DataFrame, annotated: str, tries: Column, marked: str, method: str) -> DataFrame:
    text = F.col(annotated)
    rows = df.withColumn("_found", find_spans(text, tries, needs_left(F.col("connect")), F.col("spots_surface"), F.col("spots_sound")))
    spans = snap_spans(text, F.col("_found.spans"), F.col("_found.plane"))
    shown = F.array_join(F.transform(F.col("_found.spans"), lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return rows.withColumn(marked, F.when(F.col("_found").isNotNull(), apply_marks(text, spans))).withColumn(
        method, F.col("_found.method")).withColumn(f"{method}_spans", shown).drop("_found")


def mark_patterns(df: DataFrame, keys: list[str], lexicon: DataFrame, annotated: str = "ja") -> DataFrame:
    """Adds marked, mark_method and mark_method_spans; null where the head is not realised.

    ``df``: keys, ja, head, connect.
    """
    rows = with_spots(df, keys, annotated, lexicon).withColumn("_forms", head_forms(F.col("head")))
    return _marked(rows, annotated, attempts(F.col("_forms"), ""), "marked", "mark_method").drop("_forms", "spots_surface", "spots_sound")


def mark_from_connections(df: DataFrame, keys: list[str], lexicon: DataFrame, annotated: str = "ja") -> DataFrame:
    """The same with the literal forms found in the connection shapes; methods start with ``connect-``."""
    rows = with_spots(df, keys, annotated, lexicon).withColumn("_forms", connect_forms(F.col("connect"), head_forms(F.col("head"))))
    return _marked(rows, annotated, attempts(F.col("_forms"), "connect-"), "marked", "mark_method").drop("_forms", "spots_surface", "spots_sound")


def mark_with_pieces(annotated: Column, pieces: Column) -> Column:
    """Mark supplied plain pieces, each behind the one before; null when any is missing."""
    tidy = F.filter(F.transform(F.coalesce(pieces, F.expr(_STRINGS)), strip), lambda p: p != "")
    start = F.expr("named_struct('at', 0, 'ok', true, 'all', cast(array() as array<struct<s:int,e:int>>))")

    def walk(text: Column, wanted: Column) -> Column:
        def step(s: Column, p: Column) -> Column:
            found = F.call_function("locate", p, text, s["at"] + 1) - 1
            stop = found + F.length(p)
            return F.struct(
                F.when(found >= 0, stop).otherwise(s["at"]).alias("at"), (s["ok"] & (found >= 0)).alias("ok"),
                F.array_append(s["all"], F.struct(found.alias("s"), stop.alias("e"))).alias("all"))

        return F.when(F.size(wanted) > 0, F.aggregate(wanted, start, step, lambda s: F.when(s["ok"], s["all"])))

    spans = let(walk, plane(annotated, "surface"), tidy)
    return let(lambda x: F.when(x.isNotNull(), apply_marks(annotated, snap_spans(annotated, x, "surface"))), spans)


# --- M15 ---
def overruns(head: Column, spans: Column) -> Column:
    """Characters by which the marked pieces exceed what the closest form of the head allows."""

    def measure(forms: Column, pieces: Column) -> Column:
        count = F.greatest(F.size(pieces), F.lit(1))
        sized = F.transform(forms, lambda f, i: F.struct(
            F.abs(F.size(f) - count).alias("far"), i.alias("i"), F.size(f).alias("n"),
            F.aggregate(f, F.lit(0), lambda a, x: a + F.length(x)).alias("len")))
        form = F.array_min(sized)
        budget = (form["len"] + SLACK * form["n"]) * F.greatest(F.lit(1), F.ceil(count / form["n"]))
        total = F.aggregate(pieces, F.lit(0), lambda a, x: a + F.length(x))
        return F.when(F.size(forms) == 0, F.lit(0).cast("long")).otherwise(F.greatest(F.lit(0).cast("long"), total - budget))

    return let(measure, head_forms(head), spans)


def has_wildcard(head: Column) -> Column:
    return head.rlike("[～〜]")


def mark_waterfall(df: DataFrame, keys: list[str], lexicon: DataFrame) -> DataFrame:
    """Mechanical marks, then supplied pieces, then connection forms: keys, ja, marked, mark_method, revoked.

    ``df``: keys, ja, head, connect, pieces (answers, may be null), legacy (one old piece, may be null).
    Over-long answers of wildcard heads are revoked; old pieces only seed heads without wildcard.
    """
    head, ja = F.col("head"), F.col("ja")
    long = has_wildcard(head) & (overruns(head, F.col("pieces")) > 0)
    seeded = F.when(F.col("pieces").isNotNull(), F.when(~long, F.col("pieces"))).when(
        ~has_wildcard(head) & (strip(F.coalesce("legacy", F.lit(""))) != ""), F.array(strip(F.col("legacy"))))
    rows = df.withColumn("revoked", F.coalesce(F.col("pieces").isNotNull() & long, F.lit(False))).withColumn("_pieces", seeded)
    spotted = with_spots(rows, keys, "ja", lexicon).withColumn("_forms", head_forms(head))
    first = _marked(spotted, "ja", attempts(F.col("_forms"), ""), "_m1", "_w1")
    second = first.withColumn("_m2", F.when(F.col("_w1").isNull(), mark_with_pieces(ja, F.col("_pieces"))))
    open_ = F.col("_w1").isNull() & F.col("_m2").isNull()
    late = F.when(open_, connect_forms(F.col("connect"), F.col("_forms"))).otherwise(F.expr("cast(array() as array<array<string>>)"))
    third = _marked(second.withColumn("_late", late), "ja", attempts(F.col("_late"), "connect-"), "_m3", "_w3")
    return third.select(
        *keys, "ja", F.coalesce("_m1", "_m2", "_m3", "ja").alias("marked"),
        F.coalesce("_w1", F.when(F.col("_m2").isNotNull(), F.lit("model")), "_w3").alias("mark_method"), "revoked")


# --- D1 ---
def audit_marks(df: DataFrame, keys: list[str], lexicon: DataFrame) -> DataFrame:
    """(keys, severity, reason) for marked examples; ``df``: keys, ja, marked, mark_method, head."""
    ja, marked = F.col("ja"), F.coalesce(F.when(F.col("marked") != "", F.col("marked")), F.col("ja"))
    rows = with_spots(df.withColumn("_marked", marked), keys, "ja", lexicon)
    rows = rows.withColumn("_spans", mark_spans(F.col("_marked"))).withColumn("_forms", head_forms(F.col("head")))
    rows = rows.withColumn("_flat", F.transform("_spans", plain_surface)).withColumn("_plain", plane(ja, "surface"))
    broken = F.regexp_replace("_marked", r"\*", "") != ja
    split = mark_in_chunk(F.col("_marked"))
    start = F.expr("named_struct('at', 0, 'cut', false)")

    def step(s: Column, p: Column) -> Column:
        found = F.when(s["at"] < 0, F.lit(-1)).otherwise(F.call_function("locate", p, F.col("_plain"), s["at"] + 1) - 1)
        stop = found + F.length(p)
        inside = F.exists("spots_surface", lambda w: (w["s"] <= found) & (stop <= w["e"]) & ((w["s"] < found) | (stop < w["e"])))
        return F.struct(F.when(found < 0, F.lit(-1)).otherwise(stop).alias("at"), (s["cut"] | ((found >= 0) & inside)).alias("cut"))

    cut = F.aggregate("_flat", start, step, lambda s: s["cut"])
    over = overruns(F.col("head"), F.col("_flat"))
    sized = F.transform("_forms", lambda f, i: F.struct(F.abs(F.size(f) - F.size("_flat")).alias("far"), i.alias("i"), f.alias("f")))
    form = F.array_min(sized)["f"]
    method = F.coalesce("mark_method", F.lit(""))
    mechanical = (method != "") & (method != "model") & ~method.startswith("connect-")
    flat = F.array_join("_flat", "")
    sound = F.array_join(F.transform("_spans", lambda p: plane(p, "sound")), "")

    def shares(piece: Column) -> Column:
        begin = F.substring(piece, 1, 2)
        return (piece != "") & (F.contains(flat, begin) | F.contains(sound, begin))

    def rule(cond: Column, severity: Column, reason: str) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.struct(severity.alias("severity"), F.lit(reason).alias("reason")))

    some, whole, formed = F.size("_spans") > 0, ~broken, F.size("_forms") > 0
    fail, warn = F.lit("FAIL"), F.lit("WARN")
    found = F.array_compact(F.array(
        rule(F.length(F.regexp_replace("_marked", "[^*]", "")) % 2 == 1, fail, "unpaired marks"),
        rule(broken, fail, "text changes without marks"),
        rule(whole & split, fail, "mark inside a chunk"),
        rule(whole & some & cut, warn, "inside a word"),
        rule(whole & some & formed & (over > 0), F.when(has_wildcard(F.col("head")) & (over > SLACK), fail).otherwise(warn), "longer than the pattern"),
        rule(whole & some & formed & (F.size(form) > 1) & (F.size("_flat") == 1), warn, "one piece of a split pattern"),
        rule(whole & some & formed & mechanical & ~F.exists(form, shares), warn, "no letters shared with the head"),
    ))
    return rows.select(*keys, F.posexplode_outer(found).alias("_i", "_f")).where("_i is not null").select(*keys, "_f.severity", "_f.reason")
