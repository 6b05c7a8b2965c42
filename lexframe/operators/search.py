"""Term index and ranked substring search for a table of queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexframe.functions.scan import TALLY, Trie, build_trie, found_in, tallied
from lexframe.functions.text import case_fold, kana_fold, let, mark_spans, plain_surface
from lexframe.operators.order import top_k
from lexframe.session import checkpointed

# --- fixed values: ranks of exact hits by kind, of unlisted kinds and of partial hits ---
KANJI_RANKS = {"key": 0, "variant": 1, "word": 2, "korean": 3, "reading": 3, "exception": 3}
GRAMMAR_RANKS = {"key": 0, "head": 0, "meaning": 2, "span": 2, "connect": 3, "level": 3}
VOCAB_RANKS = {"key": 0, "family": 1, "sense": 2, "annotation": 2, "gloss": 3, "en": 3, "band": 4}
OTHER_KIND, PARTIAL = 5, 10
TERM = ("ord", "text", "kind", "context")
GRAM = 3
#: fills up the last grams of a text; no character of a text
PAD = "\x00"
#: of a longer query so much is compared on the spot, the rest with the whole text
PIECE = 512
#: leading bits of a weight that tell its matches apart when they are counted
BAND_BITS = 11
#: rows of queries (probes, shown places) that are broadcast
BROADCAST_ROWS = 500_000
#: distinct queries of so many bytes in all, with a table of so many cells of 4 bytes, are looked for all at once
QUERY_BYTES, TRIE_CELLS = 1 << 22, 1 << 24


def term(text: Column, kind: str, context: Column) -> Column:
    return F.struct(text.cast("string").alias("text"), F.lit(kind).alias("kind"), context.cast("string").alias("context"))


def _none() -> Column:
    return F.expr("cast(array() as array<struct<text:string,kind:string,context:string>>)")


def gather_terms(df: DataFrame, terms: Column, weight: Column) -> DataFrame:
    """(key, weight, terms): what ``build_terms`` gives, as an array (ord, text, kind, context) per record."""
    kept = F.filter(terms, lambda t: t["text"].isNotNull() & (t["text"] != ""))
    return df.select("key", weight.cast("long").alias("weight"), F.transform(kept, lambda t, i: F.struct(i.alias("ord"), *[t[c].alias(c) for c in TERM[1:]])).alias("terms"))


def build_terms(df: DataFrame, terms: Column, weight: Column) -> DataFrame:
    """(key, ord, text, kind, context, weight) from an array of terms per record, in the array's order."""
    return gather_terms(df, terms, weight).select("key", "weight", F.inline("terms")).select("key", *TERM, "weight")


def _examples(bucket: Column, own: str, alias: str | None) -> Column:
    """Terms of a map from reading to examples (w, ko): the key, its fold, and three per example."""
    def entry(e: Column) -> Column:
        key = e["key"]
        words = F.flatten(F.transform(e["value"], lambda x: F.array(
            term(plain_surface(x["w"]), "word", key), term(x["ko"], "meaning", key), term(x["w"], "annotation", key))))
        heads = F.array(term(key, own, key)) if alias is None else F.array_compact(F.array(
            term(key, own, key), F.when(kana_fold(key) != key, term(kana_fold(key), alias, key))))
        return F.concat(heads, words)

    return F.coalesce(F.flatten(F.transform(F.map_entries(bucket), entry)), _none())


def kanji_terms(df: DataFrame, tag_labels: dict[str, str]) -> DataFrame:
    """``df``: key, tag, variant map, korean map of arrays, readings, except, korean_src."""
    labels = F.create_map(*[F.lit(x) for pair in tag_labels.items() for x in pair])
    label = F.coalesce(F.try_element_at(labels, F.col("tag")), F.lit(""))
    variants = F.flatten(F.transform(F.map_entries("variant"), lambda e: F.array(term(e["key"], "variant", e["value"]), term(e["value"], "variant_label", e["key"]))))
    korean = F.flatten(F.transform(F.map_entries("korean"), lambda e: F.concat(
        F.when(e["key"] != "본", F.array(term(e["key"], "korean_form", e["key"]))).otherwise(_none()), F.transform(e["value"], lambda v: term(v, "korean", e["key"])))))
    terms = F.concat(
        F.array(term(F.col("key"), "key", F.lit("본자"))), variants, F.array(term(F.col("tag"), "tag", label), term(label, "tag", F.col("tag"))), korean,
        _examples(F.col("readings"), "reading", "reading_alias"), _examples(F.col("except"), "exception", None),
        F.array(term(F.col("korean_src"), "korean_src", F.lit("한국 훈음 출처"))))
    size = lambda c: F.aggregate(F.map_values(c), F.lit(0), lambda a, x: a + F.size(x))
    return build_terms(df, terms, size("readings") + size("except"))


def grammar_terms(df: DataFrame, levels: dict[str, str]) -> DataFrame:
    """``df``: key, head, level, gloss_ko, gloss_ja, gloss_en, note_ko, connect, examples (ja, marked, ko)."""
    table = F.create_map(*[F.lit(x) for pair in levels.items() for x in pair])
    fields = [("gloss_ko", "meaning"), ("gloss_ja", "gloss"), ("gloss_en", "gloss"), ("note_ko", "note")]

    def example(x: Column) -> Column:
        span = plain_surface(F.array_join(mark_spans(F.coalesce(F.when(x["marked"] != "", x["marked"]), x["ja"])), ""))
        return F.array(term(plain_surface(x["ja"]), "example", F.lit("예문")), term(x["ja"], "annotation", F.lit("예문")),
                       term(x["ko"], "translation", F.lit("해석")), term(span, "span", F.lit("문법 구간")))

    terms = F.concat(
        F.array(term(F.col("key"), "key", F.lit("표제형")), term(F.col("head"), "head", F.lit("표제형")), term(F.try_element_at(table, F.col("level")), "level", F.lit("급수"))),
        F.array(*[term(F.col(c), kind, F.lit(c)) for c, kind in fields]),
        F.transform("connect", lambda s: term(s, "connect", F.lit("접속형"))), F.flatten(F.transform("examples", example)))
    return build_terms(df, terms, F.size("examples"))


def vocab_terms(df: DataFrame, bands: dict[str, str]) -> DataFrame:
    """``df``: key, family, senses (ja, gloss, en), band, rank."""
    table = F.create_map(*[F.lit(x) for pair in bands.items() for x in pair])

    def sense(s: Column) -> Column:
        return F.array(term(plain_surface(s["ja"]), "sense", F.lit("일본어")), term(s["ja"], "annotation", F.lit("일본어")),
                       term(s["gloss"], "gloss", F.lit("뜻풀이")), term(s["en"], "en", F.lit("영어 뜻풀이")))

    family = F.filter("family", lambda f: F.lower(f) != F.col("key"))
    terms = F.concat(
        F.array(term(F.col("key"), "key", F.lit("낱말"))), F.transform(family, lambda f: term(f, "family", F.lit("어형"))),
        F.flatten(F.transform("senses", sense)), F.array(term(F.coalesce(F.try_element_at(table, F.col("band")), F.col("band")), "band", F.lit("빈도대"))))
    return build_terms(df, terms, -F.col("rank"))


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _windows(chars: Column, made: Callable[[Column, Column], Column]) -> Column:
    """``made(gram, place)`` for every run of GRAM characters."""
    heads = F.slice(chars, 1, F.greatest(F.size(chars) - GRAM + 1, F.lit(0)))
    return F.transform(heads, lambda x, i: made(F.concat(x, *[F.get(chars, i + k) for k in range(1, GRAM)]), i))


def blocks(text: Column, size: int, lap: int) -> Column:
    """``text`` in pieces of ``size`` characters, each holding the first ``lap`` of the next one."""
    count = F.greatest(F.ceil((F.length(text) - lap) / (size - lap)), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.substring(text, b * (size - lap) + 1, F.lit(size)))


def _opened(df: DataFrame, block: str) -> DataFrame:
    """A row per character of ``block``: its place ``p`` from 1 and the GRAM characters from there on."""
    return df.select("*", F.explode(F.sequence(F.lit(1), F.length(block))).alias("p")).withColumn("gram", F.substring(F.col(block), F.col("p"), F.lit(GRAM)))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n): how often each gram stands in ``texts`` (text, ending in PAD); about, where blocks overlap."""
    return _opened(texts.select(F.explode(blocks(F.col("text"), 256, GRAM - 1)).alias("block")), "block").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def probes(asked: DataFrame, counts: DataFrame, piece: int = PIECE) -> DataFrame:
    """(q, gram, off, piece): where to look for each of the distinct folded queries ``asked`` (q).

    A query of GRAM characters or more is looked for by its rarest gram, a shorter one by every known
    gram that starts with it. ``piece`` is the query itself, or so much of a long one around its gram,
    which stands ``off`` characters behind the start of the piece.
    """
    long, short = asked.where(F.length("q") >= GRAM), asked.where(F.length("q") < GRAM)
    places = let(lambda c: _windows(c, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at"))), _chars(F.col("q")))
    spread = long.select("q", F.inline(places)).join(counts, "gram", "left")
    rarest = spread.groupBy("q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at")).alias("r"))
    first = F.least(F.greatest(F.col("r.at") + GRAM - piece, F.lit(0)), F.col("r.at"))
    by_rarest = rarest.select("q", F.col("r.gram").alias("gram"), (F.col("r.at") - first).alias("off"), F.substring("q", first + 1, F.lit(piece)).alias("piece"))
    heads = counts.select("gram", F.explode(F.array(*[F.struct(F.left("gram", F.lit(k)).alias("q")) for k in range(1, GRAM)])).alias("h")).select("gram", "h.q").distinct()
    return by_rarest.union(short.join(heads, "q").select("q", "gram", F.lit(0).alias("off"), F.col("q").alias("piece")))


def band(weight: Column) -> Column:
    """``weight`` rounded down to its leading bits: same order, few values; the least for null."""
    bits = F.length(F.bin(weight.bitwiseXOR(F.shiftright(weight, 63))))
    low = F.greatest(bits - BAND_BITS, F.lit(0))
    return F.coalesce(F.call_function("shiftleft", F.call_function("shiftright", weight, low), low), F.lit(-(1 << 63)))


def pairs(records: DataFrame, sought: DataFrame, longest: int, held: Column | None = None) -> DataFrame:
    """(key, q, weight, band): the queries found in each record, every one once.

    A query is taken where it stands first in a block; only records of several blocks can give it again.
    ``held``: a condition on a record and a query that is judged before the texts are compared.
    """
    size, lap = max(256, 4 * longest), longest + GRAM
    # whole texts would be copied for each of their grams; a block is as long as some pieces
    parts = records.select("key", "weight", "band", (F.length("text") <= size).alias("alone"), F.explode(blocks(F.col("text"), size, lap)).alias("block"))
    met = _opened(parts, "block").join(sought, "gram")
    start = F.col("p") - F.col("off")
    first = (F.substring(F.col("block"), start, F.length("piece")) == F.col("piece")) & (F.instr(F.col("block"), F.col("piece")) == start)
    met = met.where(first if held is None else held & first).select("key", "q", "weight", "band", "alone")
    if longest >= PIECE:
        whole = records.select("key", "text")
        met = met.join(whole, "key").where((F.length("q") <= PIECE) | F.contains("text", F.col("q"))).drop("text")
    again = met.where(~F.col("alone")).groupBy("key", "q").agg(F.max("weight").alias("weight"), F.max("band").alias("band"))
    return met.where("alone").drop("alone").unionByName(again)


def _near(df: DataFrame, rows: int) -> DataFrame:
    # queries and their grams: broadcast up to the bound, dealt beyond it
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _cuts(tally: DataFrame, limit: int) -> DataFrame:
    """(q, cut, total) from the matches ``n`` per query and band: one is shown only if fewer than ``limit`` have a higher band."""
    above = F.coalesce(F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return checkpointed(tally.withColumn("above", above).groupBy("q").agg(F.min(F.when(F.col("above") < limit, F.col("band"))).alias("cut"), F.sum("n").alias("total")))


def _trie(asked: DataFrame, number: int) -> tuple[Trie, DataFrame] | None:
    """A trie of all queries and their numbers in it (number, q); None if they are too many or too long for one."""
    octets = asked.agg(F.sum(F.octet_length("q"))).first()[0]
    if not 0 < number <= BROADCAST_ROWS or octets > QUERY_BYTES:
        return None
    numbered = asked.select((F.row_number().over(Window.orderBy("q")) - 1).alias("number"), "q")
    trie = build_trie([bytes(r.q) for r in numbered.select("number", F.col("q").cast("binary").alias("q")).orderBy("number").collect()], TRIE_CELLS)
    return trie and (trie, numbered)


def _rows_by_key(terms: DataFrame) -> DataFrame:
    """(key, weight, terms) with one row per key, its largest weight and all its terms in order.

    Only rows whose key (by its hash) stands again are brought together, so that texts are not dealt for nothing.
    """
    def joined(rows: DataFrame, every: Column) -> DataFrame:
        return checkpointed(rows.groupBy("key").agg(F.max("weight").alias("weight"), every.alias("terms")))

    if "terms" not in terms.columns:
        return joined(terms.select("key", "weight", F.struct(*TERM).alias("term")), F.sort_array(F.collect_set("term")))
    every = F.sort_array(F.flatten(F.collect_set("terms")))
    again = checkpointed(terms.groupBy(F.xxhash64("key").alias("hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))
    number = again.count()
    if number > BROADCAST_ROWS:
        return joined(terms, every)
    if not number:
        return terms
    hashed = terms.withColumn("hash", F.xxhash64("key"))
    several = joined(hashed.join(F.broadcast(again), "hash", "left_semi"), every)
    return hashed.join(F.broadcast(again), "hash", "left_anti").drop("hash").unionByName(several)


def _kind_rank(kind: Column, ranks: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit(OTHER_KIND))


def by_trie(records: DataFrame, trie: Trie, numbered: DataFrame, ranks: dict[str, int], limit: int) -> DataFrame:
    """(q, place, key, total, best): every text is walked twice, to count the matches and for those that can be shown."""
    context, names = records.sparkSession.sparkContext, F.broadcast(numbered)
    shared = context.broadcast(tuple(trie))
    folded = records.select("*", band(F.col("weight")).alias("level"), F.transform("terms", lambda t: case_fold(t["text"])).alias("texts"))
    tally = folded.select("level", "texts").mapInArrow(tallied(shared), TALLY)
    stats = _cuts(tally.groupBy(F.col("number").alias("q"), F.col("level").alias("band")).agg(F.sum("n").alias("n")), limit)
    # a query without a match has no cut and stands nowhere
    lowest = np.full(len(trie.ends), np.iinfo(np.int64).max)
    for r in stats.select("q", "cut").collect():
        lowest[r.q] = r.cut
    found = found_in(shared, context.broadcast(lowest))(F.col("texts"), F.col("level"))

    def match(t: Column, i: Column) -> Column:
        # hits of a whole text come before all others, whatever their weight
        rank = F.when(F.get("texts", i) == F.col("q"), _kind_rank(t["kind"], ranks)).when(F.contains(F.get("texts", i), F.col("q")), F.lit(PARTIAL))
        return F.when(rank.isNotNull(), ranked(rank, t))

    def ranked(rank: Column, t: Column) -> Column:
        return F.struct(rank.alias("rank"), *[t[c].alias(c) for c in TERM])

    # terms lie in order, so the first one is the best where it holds the query and none is the query
    plain = F.contains(F.get("texts", F.lit(0)), F.col("q")) & ~F.array_contains("texts", F.col("q"))
    best = F.when(plain, ranked(F.lit(PARTIAL), F.get("terms", F.lit(0)))).otherwise(F.array_min(F.transform("terms", match)))
    met = folded.select("key", "weight", "terms", "texts", F.explode(found).alias("number")).join(names, "number")
    shown = top_k(met.select("number", "q", "key", "weight", best.alias("best")), ["number"], [F.col("best.rank"), F.desc("weight"), F.col("key")], limit, "place")
    return shown.join(stats.select(F.col("q").alias("number"), "total"), "number").select("q", "place", "key", "total", "best")


def by_grams(records: DataFrame, asked: DataFrame, number: int, ranks: dict[str, int], limit: int) -> DataFrame:
    """The same for queries too many or too long for one trie: each sends one gram, its rarest, to the texts; what it meets is verified on the spot."""
    # what is searched; texts as written and their contexts are only joined to what is shown
    head = F.transform("terms", lambda t: F.struct(case_fold(t["text"]).alias("text"), _kind_rank(t["kind"], ranks).alias("rank")))
    heads = checkpointed(records.select("key", "weight", band(F.col("weight")).alias("band"), F.array_distinct(head).alias("heads")))
    whole = F.concat(F.array_join(F.array_distinct(F.col("heads.text")), PAD * (GRAM - 1)), F.lit(PAD * (GRAM - 1)))
    texts = heads.select("key", "weight", "band", whole.alias("text"))
    probe = checkpointed(probes(asked, checkpointed(gram_counts(texts))))
    probed, longest = probe.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("piece")), F.lit(1))).first()
    stats = _cuts(pairs(texts, _near(probe, probed), longest).groupBy("q", "band").agg(F.count(F.lit(1)).alias("n")), limit)
    partial = pairs(texts, _near(probe.join(stats.select("q", "cut"), "q"), probed), longest, F.col("band") >= F.col("cut"))
    # hits of a whole text come before all others, whatever their weight
    exact = heads.select("key", "weight", F.inline("heads")).join(_near(asked, number), F.col("text") == F.col("q"))
    best = partial.select("key", "q", "weight", F.lit(PARTIAL).alias("rank")).unionByName(exact.select("key", "q", "weight", "rank")).groupBy("key", "q").agg(
        F.min("rank").alias("rank"), F.max("weight").alias("weight"))
    shown = top_k(best, ["q"], [F.col("rank"), F.desc("weight"), F.col("key")], limit, "place").join(stats.select("q", "total"), "q")
    shown = checkpointed(shown.select("q", "place", "key", F.col("rank").alias("_rank"), "total"))
    folded = case_fold(F.col("text"))
    rank = F.when(folded == F.col("q"), _kind_rank(F.col("kind"), ranks)).when(F.contains(folded, F.col("q")), F.lit(PARTIAL))
    written = records.select("key", F.inline("terms")).join(_near(shown, shown.count()), "key").where(rank == F.col("_rank"))
    return written.groupBy("q", "place", "key", "total").agg(F.min(F.struct(F.col("_rank").alias("rank"), *TERM)).alias("best"))


def search(terms: DataFrame, queries: DataFrame, ranks: dict[str, int], limit: int = 80) -> DataFrame:
    """(qid, query, place, key, match_kind, matched_text, match_context, exact, total) per query.

    ``terms``: as ``gather_terms`` gives them, or as ``build_terms`` does. The texts of a record are
    looked through for the matches of every query by weight, and again for those that can be among its
    first ``limit``: no other match is dealt or sorted. Queries are looked for all at once by a trie,
    those beyond its bounds by their grams. A record has one weight (the largest given for its key).
    Blank queries match nothing.
    """
    q = queries.select("qid", F.trim("query").alias("query")).where("query <> ''").withColumn("q", case_fold(F.col("query")))
    records, asked = _rows_by_key(terms), checkpointed(q.select("q").distinct())
    number = asked.count()
    trie = _trie(asked, number)
    shown = by_grams(records, asked, number, ranks, limit) if trie is None else by_trie(records, *trie, ranks, limit)
    return q.join(shown, "q").select(
        "qid", "query", "place", "key", F.col("best.kind").alias("match_kind"), F.col("best.text").alias("matched_text"), F.col("best.context").alias("match_context"),
        (F.col("best.rank") < PARTIAL).alias("exact"), "total")
