"""Verification of surfaces and readings against a dictionary table (surface, reading, reading_ord, pos)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import (
    BASE, after, annotation_ok, contains_family, drop_printed, full_reading, kana_fold, let, plain_surface, reading_norm, search_stem, segments, voiced_forms,
)
from lexframe.operators.align import alignments

# --- fixed values: tails tried in this order ---
TAILS = ("する", "した", "して", "な", "に", "と", "だ", "の")


def verify_readings(df: DataFrame, dictionary: DataFrame, surface: str = "surface", kana: str = "kana", tails: tuple[str, ...] = TAILS) -> DataFrame:
    """Grade every distinct (surface, kana): ``jmdict``, ``unsure`` (with the dictionary reading) or ``phrase``.

    The first headword present decides, in the order surface, surface minus each tail.  Repeated
    pairs are merged before any join, so copies cost nothing downstream.
    """
    s = F.col(surface)
    heads = F.filter(
        F.array(F.struct(F.lit(0).alias("ord"), s.alias("head"), F.lit("").alias("tail")), *[
            F.when(s.endswith(t) & (F.length(s) > len(t)), F.struct(
                F.lit(i).alias("ord"), F.substring(s, F.lit(1), F.length(s) - len(t)).alias("head"), F.lit(t).alias("tail")))
            for i, t in enumerate(tails, 1)
        ]), lambda x: x.isNotNull())
    pairs = df.select(surface, kana).distinct()
    tried = pairs.select(surface, kana, F.explode(heads).alias("h")).select(surface, kana, "h.ord", "h.head", "h.tail")
    known = dictionary.select(F.col("surface").alias("head"), F.col("reading").alias("_known")).distinct()
    joined = tried.join(known, "head", "left")
    wrong = F.concat(kana_fold(F.col("_known")), kana_fold(F.col("tail"))) != kana_fold(F.col(kana))
    ranked = F.struct("ord", wrong.alias("wrong"), F.length("_known").alias("n"), "_known", "tail")
    best = joined.groupBy(surface, kana).agg(F.min(F.when(F.col("_known").isNotNull(), ranked)).alias("_b"))
    b = F.col("_b")
    return best.select(
        surface, kana,
        F.when(b.isNull(), "phrase").when(b["wrong"], "unsure").otherwise("jmdict").alias("grade"),
        F.when(b["wrong"], F.concat(b["_known"], b["tail"])).otherwise(F.col(kana)).alias("reading"))


def stem_readings(dictionary: DataFrame) -> DataFrame:
    """(surface, reading): base prefix and the reading left after the shared okurigana."""
    s = F.col("surface")
    stem = F.regexp_extract(s, f"^(.*[{BASE}])[^{BASE}]+$", 1)
    tail = kana_fold(after(s, F.length(stem) + 1))
    plain = kana_fold(F.col("reading"))
    rows = dictionary.select(stem.alias("stem"), tail.alias("tail"), plain.alias("plain")).where("stem <> ''")
    kept = rows.where(F.col("plain").endswith(F.col("tail")) & (F.length("plain") > F.length("tail")))
    return kept.select(
        F.col("stem").alias("surface"), F.substring("plain", F.lit(1), F.length("plain") - F.length("tail")).alias("reading")).distinct()


def fit_table(dictionary: DataFrame) -> DataFrame:
    """(kind, head, form): voiced closure of dictionary readings (kind d) and of stems (kind s)."""
    def forms(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.col("surface").alias("head"), F.explode(voiced_forms(kana_fold(F.col("reading")))).alias("form"))

    return forms(dictionary, "d").unionByName(forms(stem_readings(dictionary), "s")).distinct()


def base_runs(surface: Column) -> Column:
    """Array of (surface, tail): distinct base runs with the literal that follows them."""
    found = F.regexp_extract_all(surface, F.lit(f"[{BASE}]+|[^{BASE}]+"), F.lit(0))

    def pick(parts: Column) -> Column:
        shaped = F.transform(parts, lambda p, i: F.when(p.rlike(f"^[{BASE}]"), F.struct(
            p.alias("surface"), F.coalesce(F.get(parts, i + 1), F.lit("")).alias("tail"))))
        return F.array_distinct(F.array_compact(shaped))

    return let(pick, found)


def attach_known(df: DataFrame, cols: list[str], surface: str, fits: DataFrame, longest: int | None = None) -> DataFrame:
    """(cols, known): distinct rows with (surface, tail, allowed) of the runs the dictionary knows.

    Every growing prefix of a run's tail is tried as part of a headword, in one pass over the rows, up
    to the length of the longest head in ``fits`` (or ``longest``, where it is known).
    """
    head = F.coalesce(fits.agg(F.max(F.length("head"))).scalar(), F.lit(0)) if longest is None else F.lit(longest)
    df = df.withColumn("_longest", head)

    def asked(r: Column) -> Column:
        n = F.least(F.length(r["tail"]), F.greatest(F.lit(0), F.col("_longest") - F.length(r["surface"])))

        def item(kind: str, head: Column, more: Column) -> Column:
            return F.struct(r["surface"].alias("surface"), r["tail"].alias("tail"), F.lit(kind).alias("kind"), head.alias("head"), more.alias("more"))

        grown = F.transform(F.sequence(F.lit(0), n), lambda k: item("d", F.concat(r["surface"], F.substring(r["tail"], F.lit(1), k)), kana_fold(F.substring(r["tail"], F.lit(1), k))))
        return F.array_append(grown, item("s", r["surface"], F.lit("")))

    rows = df.select(*cols, F.explode_outer(F.flatten(F.transform(base_runs(F.col(surface)), asked))).alias("_a"))
    opened = rows.select(*cols, F.col("_a.surface").alias("_s"), F.col("_a.tail").alias("_t"), F.col("_a.kind").alias("_k"), F.col("_a.head").alias("_h"), F.col("_a.more").alias("_m"))
    table = fits.select(F.col("kind").alias("_k"), F.col("head").alias("_h"), F.col("form").alias("_f"))
    met = opened.join(table, ["_k", "_h"], "left")
    own = F.when(F.col("_f").endswith(F.col("_m")), F.substring("_f", F.lit(1), F.length("_f") - F.length("_m")))
    per_run = met.groupBy(*cols, "_s", "_t").agg(F.collect_set(own).alias("allowed"), F.count("_f").alias("_n"))
    known = F.when(F.col("_n") > 0, F.struct(F.col("_s").alias("surface"), F.col("_t").alias("tail"), "allowed"))
    return per_run.groupBy(*cols).agg(F.collect_list(known).alias("known"))


def judge_readings(annotated: Column, known: Column) -> Column:
    """(fits_long, fits_all): do the runs of two or more characters, and all runs, read as the dictionary allows."""
    def judged(parts: Column, table: Column) -> Column:
        def fits(seg: Column, i: Column) -> Column:
            following = F.get(parts, i + 1)
            tail = F.when(following["reading"].isNull(), F.coalesce(following["surface"], F.lit(""))).otherwise(F.lit(""))
            entry = F.filter(table, lambda k: (k["surface"] == seg["surface"]) & (k["tail"] == tail))
            return F.size(entry).isNull() | (F.size(entry) < 1) | F.array_contains(F.get(entry, F.lit(0))["allowed"], kana_fold(seg["reading"]))

        verdicts = F.transform(parts, lambda seg, i: F.struct(
            (seg["reading"].isNull() | (F.length(seg["surface"]) < 2)).alias("short"),
            (seg["reading"].isNull() | fits(seg, i)).alias("ok")))
        return let(lambda v: F.struct(
            F.forall(v, lambda x: x["ok"] | x["short"]).alias("fits_long"), F.forall(v, lambda x: x["ok"]).alias("fits_all")), verdicts)

    return let(judged, segments(annotated), known)


def readings_fit(df: DataFrame, keys: list[str], annotated: str, fits: DataFrame, longest: int | None = None) -> DataFrame:
    """(keys, annotated, fits_long, fits_all) of rows with an annotated text."""
    rows = attach_known(df.withColumn("_plain", plain_surface(F.col(annotated))), [*keys, annotated], "_plain", fits, longest)
    return rows.withColumn("_j", judge_readings(F.col(annotated), F.col("known"))).select(
        *keys, annotated, F.col("_j.fits_long").alias("fits_long"), F.col("_j.fits_all").alias("fits_all"))


def choose_alignment(df: DataFrame, keys: list[str], fits: DataFrame, surface: str = "ja", reading: str = "kana", longest: int | None = None) -> DataFrame:
    """(keys, written, fits_long): a single alignment as it is, else the only one the dictionary allows.

    The runs of a surface are the same in all its alignments, so the dictionary is joined once per
    run and the candidates are made and judged in one pass over the rows.
    """
    rows = attach_known(df, [*keys, surface, reading], surface, fits, longest)

    def pick(cands: Column) -> Column:
        long = F.filter(cands, lambda c: c["j"]["fits_long"])
        both = F.filter(cands, lambda c: c["j"]["fits_long"] & c["j"]["fits_all"])
        return let(lambda a, b, c: F.when(F.size(a) == 1, a).when(F.size(b) == 1, b).when((F.size(b) > 1) & (F.size(c) == 1), c), cands, long, both)

    found = F.transform(alignments(F.col(surface), F.col(reading)), lambda c: F.struct(c.alias("text"), judge_readings(c, F.col("known")).alias("j")))
    chosen = rows.select(*keys, F.explode(let(pick, found)).alias("c"))
    return chosen.select(*keys, F.col("c.text").alias("written"), F.col("c.j.fits_long").alias("fits_long"))


def check_pairs(df: DataFrame, keys: list[str], fits: DataFrame, longest: int | None = None) -> DataFrame:
    """(keys, en, written, reason): sentence pairs with the first failing rule, or none.

    ``df``: keys, en, ja, kana, pos, gloss_ja (plain), family.
    """
    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name), F.lit("")))

    tidy = df.withColumn("en", text("en")).withColumn("ja", text("ja")).withColumn("kana", text("kana"))
    chosen = choose_alignment(tidy.where("ja <> '' and kana <> ''"), keys, fits, longest=longest)
    empty = (F.col("en") == "") | (F.col("ja") == "") | (F.col("kana") == "")
    reason = (
        F.when(empty, "empty answer")
        .when(~contains_family(F.col("en"), F.col("family")), "word missing in English")
        .when((F.col("pos") != "function") & ~F.contains(F.col("ja"), search_stem(F.col("gloss_ja"))), "sense missing in Japanese")
        .when(F.col("written").isNull(), "reading does not align")
        .when(~F.col("fits_long"), "reading differs from the dictionary")
    )
    judged = tidy.join(chosen, keys, "left").withColumn("reason", reason)
    return judged.select(*keys, "en", F.when(F.col("reason").isNull(), F.col("written")).alias("written"), "reason")


def boundary_evidence(dictionary: DataFrame, needs: DataFrame) -> DataFrame:
    """(ch, reading, surface): verb entries of one base character plus hiragana, for needed pairs only.

    ``dictionary`` carries ``pos`` (array of tags); ``needs`` is (ch, reading).
    """
    cjk = r"\x{3400}-\x{9FFF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}"
    verb = F.exists("pos", lambda p: p.startswith("&v") | (p == "&aux-v;"))
    shaped = F.col("surface").rlike(f"^[ぁ-ゖゝゞー]*[{cjk}][ぁ-ゖゝゞー]*$")
    rows = dictionary.where(verb & shaped).select(
        F.regexp_extract("surface", f"[{cjk}]", 0).alias("ch"), kana_fold(F.col("reading")).alias("reading"), "surface").distinct()
    return rows.join(needs.select("ch", "reading"), ["ch", "reading"], "left_semi")


def dictionary_ok(df: DataFrame, dictionary: DataFrame, records: DataFrame) -> DataFrame:
    """Adds ``ok``: table readings bind single characters of listed records, the dictionary binds the rest.

    ``df``: w, annotated, key.  ``records``: ch, tag.  Unknown surfaces pass; for known ones an
    annotation that cannot be parsed is refused.
    """
    listed = records.where("tag <> 'h'").select(F.col("ch").alias("w"), F.lit(True).alias("_listed"))
    bare = df.withColumn("_bare", drop_printed(F.col("w"))).withColumn("_all", full_reading(F.col("annotated")))
    known = dictionary.select(F.col("surface").alias("_bare"), kana_fold(F.col("reading")).alias("_known")).distinct()
    asked = bare.select("_bare", "_all").distinct().join(known, "_bare").groupBy("_bare", "_all").agg(
        F.max(F.col("_known") == kana_fold(F.col("_all"))).alias("_hit"))
    joined = bare.join(listed, "w", "left").join(asked, ["_bare", "_all"], "left")
    by_table = reading_norm(F.col("_all")) == reading_norm(F.col("key"))
    parsed = F.coalesce(annotation_ok(F.col("annotated")), F.lit(False))
    ok = F.when(F.col("_hit").isNull(), F.lit(True)).when(~parsed, F.lit(False)).when(F.col("_listed") & F.col("key").isNotNull(), by_table).otherwise(F.col("_hit"))
    return joined.select(*df.columns, ok.alias("ok"))


def enrich_glosses(df: DataFrame, kmap: DataFrame, variants: DataFrame) -> DataFrame:
    """(key, form, ord, gloss): main glosses under ``main`` and those of each known variant.

    ``df``: key.  ``kmap``: key, ord, gloss.  ``variants``: key, variant.
    """
    main = df.select("key").join(kmap, "key").select("key", F.lit("main").alias("form"), "ord", "gloss")
    looked = variants.join(kmap.withColumnRenamed("key", "variant"), "variant").select(
        "key", F.col("variant").alias("form"), "ord", "gloss")
    return main.unionByName(looked)


def explode_targets(freq: DataFrame, targets: DataFrame, lemma: str = "lemma") -> DataFrame:
    """One row per distinct target character of every lemma."""
    chars = freq.withColumn("ch", F.explode(F.array_distinct(F.regexp_extract_all(lemma, F.lit("(?s:.)"), F.lit(0)))))
    return chars.join(targets.select("ch"), "ch", "left_semi")


def longest_word(lexicon: DataFrame) -> Column:
    """Length of the longest word of the lexicon, as one value; 0 for an empty one."""
    return F.coalesce(lexicon.agg(F.max(F.length("word"))).scalar(), F.lit(0))


#: characters of the head by which a lexicon's words are looked up
HEAD = 2


def head_index(lexicon: DataFrame, shortest: int = HEAD) -> DataFrame:
    """(head, sizes): per beginning of HEAD characters the lengths of the lexicon's words; a row per head."""
    words = lexicon.where(F.length("word") >= shortest)
    return words.groupBy(F.left("word", F.lit(HEAD)).alias("_head")).agg(F.sort_array(F.collect_set(F.length("word"))).alias("_sizes"))


def lexicon_spots(df: DataFrame, keys: list[str], text: str, lexicon: DataFrame, shortest: int = HEAD) -> DataFrame:
    """(keys, start, stop): places where a lexicon word stands; 0-based, end exclusive.

    Places where no word begins go at the head index; only lengths that its words have are cut out.
    ``shortest`` is HEAD or more.
    """
    n, start = F.length("_text"), F.col("start")
    places = df.where(F.length(text) >= shortest).select(*keys, F.col(text).alias("_text"), F.explode(F.sequence(F.lit(0), F.length(text) - shortest)).alias("start"))
    opened = places.withColumn("_head", F.substring("_text", start + 1, F.lit(HEAD))).join(head_index(lexicon, shortest), "_head")
    sizes = opened.select(*keys, "_text", "start", F.explode(F.filter("_sizes", lambda k: k <= n - start)).alias("_size"))
    grams = sizes.select(*keys, "start", (start + F.col("_size")).alias("stop"), F.substring("_text", start + 1, F.col("_size")).alias("_word"))
    return grams.join(lexicon.select(F.col("word").alias("_word")), "_word", "left_semi").select(*keys, "start", "stop")


def cut_by_word(spans: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Adds ``cut``: a strictly larger lexicon word contains the span [start, stop) of ``text``.

    Only the windows around a span that begin as some word does and are as long are looked up.
    """
    row = [*keys, "start", "stop"]
    n, begin, longest = F.length("_text"), F.col("_from"), F.col("_longest")
    left = F.sequence(F.greatest(F.lit(0), F.col("stop") - longest), F.col("start"))
    opened = spans.withColumn("_longest", longest_word(lexicon)).where(F.col("stop") - F.col("start") <= longest).select(*row, F.col(text).alias("_text"), F.explode(left).alias("_from"))
    met = opened.withColumn("_head", F.substring("_text", begin + 1, F.lit(HEAD))).join(head_index(lexicon), "_head")
    larger = F.filter("_sizes", lambda k: (begin + k >= F.col("stop")) & (begin + k <= n) & (k > F.col("stop") - F.col("start")))
    words = met.select(*row, "_text", "_from", F.explode(larger).alias("_size")).select(*row, F.substring("_text", begin + 1, F.col("_size")).alias("_word"))
    hit = words.join(lexicon.select(F.col("word").alias("_word")), "_word", "left_semi").select(*row).distinct().withColumn("cut", F.lit(True))
    return spans.join(hit, row, "left").fillna(False, ["cut"])
