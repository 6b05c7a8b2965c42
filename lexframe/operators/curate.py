"""Overlay of human edits on a base: fingerprints, diffs, optimistic edits, bulk updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lexframe.functions.text import annotation_ok, plain_surface, strip
from lexframe.operators.order import carried_value
from lexframe.session import checkpointed

#: added leaves of a diff are ordered from here on, after all of the old record
ADDED = 1 << 31
#: buckets of keys whose sums make up a dataset's fingerprint
TREE_BUCKETS = 4096
#: arrival numbers that make up a bucket of edits, and buckets that are summed up by one map
BUCKET_EDITS, SUMMARY = 512, 512


def etag(record: Column) -> Column:
    return F.sha2(F.to_json(record), 256)


def with_etag(df: DataFrame, record: str = "record", name: str = "etag") -> DataFrame:
    return df.withColumn(name, etag(F.col(record)))


# --- C2 ---
def flat_paths(value: Column, kind: T.DataType, path: Column) -> Column:
    """Array of (path, value) leaves of a nested value, in order.

    Absent and null leaves give none; an empty array or map is a leaf, ``[]`` or ``{}``.
    """
    null = F.expr("cast(array() as array<struct<path:string,value:string>>)")
    if isinstance(kind, T.StructType):
        parts = [flat_paths(value[f.name], f.dataType, F.when(path == "", F.lit(f.name)).otherwise(F.concat(path, F.lit(f".{f.name}")))) for f in kind.fields]
        return F.coalesce(F.concat(*parts), null)
    empty = F.array(F.struct(path.alias("path"), F.lit("[]" if isinstance(kind, T.ArrayType) else "{}").alias("value")))
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(value) == 0, empty).otherwise(F.coalesce(F.flatten(F.transform(value, lambda x, i: flat_paths(
            x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))), null))
    if isinstance(kind, T.MapType):
        return F.when(F.size(value) == 0, empty).otherwise(F.coalesce(F.flatten(F.transform(F.map_entries(value), lambda e: flat_paths(
            e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"].cast("string"))))), null))
    leaf = F.struct(path.alias("path"), value.cast("string").alias("value"))
    return F.when(value.isNotNull(), F.array(leaf)).otherwise(null)


def diff_records(before: DataFrame, after: DataFrame, key: str = "key", record: str = "record") -> DataFrame:
    """(key, path, before, after, order) for every leaf that differs; one aggregation instead of an outer join.

    ``order`` sorts the changes of a key: leaves of the old record in its order, then added ones in that
    of the new record.
    """
    def leaves(df: DataFrame, side: str, other: str) -> DataFrame:
        kind = df.schema[record].dataType
        rows = df.select(key, F.posexplode(flat_paths(F.col(record), kind, F.lit(""))).alias("_at", "_l"))
        at = F.col("_at").cast("long")
        return rows.select(
            key, F.col("_l.path").alias("path"), F.col("_l.value").alias(side), F.lit(None).cast("string").alias(other),
            (at if side == "before" else at + ADDED).alias("_order"))

    both = leaves(before, "before", "after").unionByName(leaves(after, "after", "before"))
    merged = both.groupBy(key, "path").agg(F.max("before").alias("before"), F.max("after").alias("after"), F.min("_order").alias("order"))
    return merged.where(~F.col("before").eqNullSafe(F.col("after")))


# --- C3, C4 ---
def keep_provenance(after: DataFrame, base: DataFrame, flag: str, gloss: str, generated: str) -> DataFrame:
    """The generated flag survives an edit only while the main gloss stays what the base says."""
    old = base.select("key", F.col(f"record.{flag}").alias("_flag"), F.col(f"record.{gloss}").alias("_gloss"))
    joined = after.join(old, "key", "left")
    stays = (F.col("_flag") == generated) & F.col(f"record.{gloss}").eqNullSafe(F.col("_gloss"))
    return joined.withColumn("record", F.col("record").withField(flag, F.when(stays, F.lit(generated)))).drop("_flag", "_gloss")


def judge_edits(edits: DataFrame, base: DataFrame, bucket_size: int = BUCKET_EDITS, summary: int = SUMMARY) -> DataFrame:
    """Adds ``status`` and ``current`` (the etag the edit met) to every edit.

    ``edits``: key, ord (arrival order, unique per key), reason, expected_etag, new_etag, valid.
    ``base``: key, etag.  An edit is saved when its reason is acceptable, it expects the current
    etag, is valid and changes something; the next edit then meets its new etag.
    """
    good = F.coalesce((F.length(strip(F.col("reason"))) > 0) & (F.length(strip(F.col("reason"))) <= 500), F.lit(False))
    rows = edits.withColumn("_good", good).join(base.select("key", F.col("etag").alias("_start")), "key", "left")
    usable = F.col("_good") & F.col("_start").isNotNull() & F.col("valid") & (F.col("new_etag") != F.col("expected_etag"))
    cand = rows.where(usable).select("key", "ord", F.col("expected_etag").alias("want"), F.col("new_etag").alias("give"), "_start")
    marked = rows.join(saved_edits(cand, bucket_size, summary).withColumn("_saved", F.lit(True)), ["key", "ord"], "left")
    # the etag an edit meets is the one given by the last saved edit before it
    met = carried_value(
        marked.withColumn("_given", F.when(F.col("_saved"), F.col("new_etag"))), ["key"], ["ord"], F.floor(F.col("ord") / bucket_size), F.col("_given"), "_after")
    before = F.when(F.col("_saved"), F.col("expected_etag")).otherwise(F.coalesce("_after", "_start"))
    status = (
        F.when(~F.col("_good"), "reason").when(F.col("_start").isNull(), "unknown")
        .when(F.col("expected_etag") != before, "conflict").when(~F.col("valid"), "invalid")
        .when(F.col("_saved"), "saved").otherwise("unchanged"))
    return met.select(*edits.columns, before.alias("current"), status.alias("status"))


def _led(moves: Column, tag: Column) -> Column:
    """Where a transition map, an array of (want, since, out), leads ``tag``; other etags stay."""
    return F.coalesce(F.get(F.filter(moves, lambda m: m["want"] == tag), F.lit(0))["out"], tag)


def _entered(parts: Column, start: Column, moves: str) -> Column:
    """(at, tag) for each of the ordered ``parts`` (at, map): the etag with which it is entered."""
    state = F.struct(start.alias("tag"), F.expr("cast(array() as array<struct<at:bigint,tag:string>>)").alias("seen"))
    return F.aggregate(parts, state, lambda s, p: F.struct(
        _led(p[moves], s["tag"]).alias("tag"), F.array_append(s["seen"], F.struct(p["at"].alias("at"), s["tag"].alias("tag"))).alias("seen")), lambda s: s["seen"])


def saved_edits(cand: DataFrame, bucket_size: int = BUCKET_EDITS, summary: int = SUMMARY) -> DataFrame:
    """(key, ord) of the edits ``cand`` (key, ord, want, give, _start) that find the etag they want.

    Each bucket of a key's edits is summed up as the map from the etag it is entered with to the one
    it leaves behind. Such maps compose, so ``summary`` buckets are summed up by one map, and a key is
    one short row per that many buckets. Down the same levels every bucket learns the etag it is
    entered with, and its edits are judged from there. A map only keeps etags that something
    before it has given; a plain chain of edits therefore has maps of one etag.
    """
    at = F.floor(F.col("ord") / bucket_size)
    placed = cand.withColumn("at", at)
    lists = placed.groupBy("key", "at").agg(
        F.first("_start").alias("_start"), F.sort_array(F.collect_list(F.struct(F.col("ord").cast("long").alias("ord"), "want", "give"))).alias("edits"))

    # from the last edit back: who enters with its want, leaves as one who enters behind it with its give
    none = F.expr("cast(array() as array<struct<want:string,since:bigint,out:string>>)")
    moves = F.aggregate(F.reverse("edits"), none, lambda m, e: F.array_append(
        F.filter(m, lambda x: x["want"] != e["want"]), F.struct(e["want"].alias("want"), F.lit(0).cast("long").alias("since"), _led(m, e["give"]).alias("out"))))
    given = placed.groupBy("key", F.col("give").alias("want")).agg(F.min("at").alias("since"))
    opened = lists.select("key", "at", "_start", F.inline(moves)).drop("since").join(given, ["key", "want"], "left")
    opened = opened.withColumn("since", F.when(F.col("want") == F.col("_start"), F.lit(-1).cast("long")).otherwise(F.col("since"))).where("since < at")
    maps = opened.groupBy("key", "at").agg(F.first("_start").alias("_start"), F.collect_list(F.struct("want", "since", "out")).alias("moves"))

    up = F.floor(F.col("at") / summary)
    groups = maps.groupBy("key", up.alias("up")).agg(F.first("_start").alias("_start"), F.sort_array(F.collect_list(F.struct("at", "moves"))).alias("parts"))
    composed = F.aggregate(F.reverse("parts"), none, lambda m, p: F.concat(
        F.filter(m, lambda x: ~F.exists(p["moves"], lambda y: y["want"] == x["want"])),
        F.transform(p["moves"], lambda y: F.struct(y["want"].alias("want"), y["since"].alias("since"), _led(m, y["out"]).alias("out")))))
    outer = F.filter(composed, lambda x: F.floor(x["since"] / summary) < F.col("up"))
    tops = groups.select("key", "_start", F.struct(F.col("up").alias("at"), outer.alias("moves")).alias("part")).groupBy("key").agg(
        F.first("_start").alias("_start"), F.sort_array(F.collect_list("part")).alias("parts"))  # an element per ``summary`` buckets
    entered = tops.select("key", F.inline(_entered(F.col("parts"), F.col("_start"), "moves"))).select("key", F.col("at").alias("up"), "tag")
    inside = groups.join(entered, ["key", "up"]).select("key", F.inline(_entered(F.col("parts"), F.col("tag"), "moves")))

    def step(s: Column, e: Column) -> Column:
        hit = e["want"] == s["now"]
        return F.struct(F.when(hit, e["give"]).otherwise(s["now"]).alias("now"), F.when(hit, F.array_append(s["ords"], e["ord"])).otherwise(s["ords"]).alias("ords"))

    state = F.struct(F.col("tag").alias("now"), F.expr("cast(array() as array<bigint>)").alias("ords"))
    return lists.join(inside, ["key", "at"]).select("key", F.explode(F.aggregate("edits", state, step, lambda s: s["ords"])).alias("ord"))


def apply_edits(base: DataFrame, edits: DataFrame, provenance: tuple[str, str, str] | None = None, moved: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(overlay, log).  ``base``: key, record.  ``edits``: key, ord, at, reason, expected_etag, record, valid.

    ``provenance`` (flag, main gloss, generated) is the rule of ``keep_provenance``, applied to what is
    submitted before its etag is taken. Edits of keys in ``moved`` (key), whose base is not the one that
    was edited, are refused with status ``moved``. The overlay holds, per edited key, the baseline and
    its etag, the last saved record, the number of saved edits (revision) and the time of the last.
    """
    given = edits if provenance is None else keep_provenance(edits, base, *provenance).select(*edits.columns)
    tagged = given.withColumn("new_etag", etag(F.col("record")))
    start = base.select("key", etag(F.col("record")).alias("etag"))
    if moved is None:
        log = judge_edits(tagged, start)
    else:
        hit = moved.select("key", F.lit(True).alias("_moved"))
        refused = tagged.join(hit.select("key"), "key", "left_semi").join(start, "key", "left")
        refused = refused.select(*tagged.columns, F.col("etag").alias("current"), F.lit("moved").alias("status"))
        log = judge_edits(tagged.join(hit, "key", "left_anti"), start).unionByName(refused)
    log = checkpointed(log)  # the overlay and what callers take from the log read it again
    saved = log.where("status = 'saved'")
    last = saved.groupBy("key").agg(F.max_by("record", "ord").alias("human"), F.count(F.lit(1)).alias("revision"), F.max("at").alias("updated_at"))
    overlay = last.join(base.select("key", F.col("record").alias("baseline")), "key").withColumn("baseline_etag", etag(F.col("baseline")))
    return overlay, log


def edit_reasons(log: DataFrame) -> DataFrame:
    """(key, reason, ord): every reason of a key's saved edits once, with its first edit."""
    saved = log.where("status = 'saved'").withColumn("reason", strip(F.col("reason")))
    return saved.groupBy("key", "reason").agg(F.min("ord").alias("ord"))


# --- J14, C5, C6 ---
def apply_overlay(base: DataFrame, overlay: DataFrame) -> DataFrame:
    """Base records with the human version where there is one; ``edited`` where it really differs."""
    o = overlay.select("key", "human", "baseline")
    edited = F.coalesce(F.to_json("human") != F.to_json("baseline"), F.lit(False))
    return base.join(o, "key", "left").select("key", F.coalesce("human", "record").alias("record"), edited.alias("edited"))


def overlay_conflicts(base: DataFrame, overlay: DataFrame) -> DataFrame:
    """Edits whose baseline is not the base's current record."""
    now = base.select("key", etag(F.col("record")).alias("base_etag"))
    return overlay.select("key", "baseline_etag").join(now, "key", "left").where(~F.col("base_etag").eqNullSafe(F.col("baseline_etag")))


def fingerprint_tree(base: DataFrame, record: str = "record", buckets: int = TREE_BUCKETS) -> DataFrame:
    """(bucket, rows, total, mixed) per bucket of keys: order-free sums of 64-bit hashes of (key, etag).

    ``total`` is the sum modulo 2^64, ``mixed`` the exclusive or of a second hash. Sums of buckets add up
    to the root, so two versions of a dataset are compared by their roots, then by their buckets.
    """
    h = base.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), F.struct("key", etag(F.col(record))).alias("h"))
    return _summed(h.select("bucket", F.lit(1).alias("rows"), F.xxhash64("h").cast("decimal(38,0)").alias("total"), F.xxhash64("h", F.lit(1)).alias("mixed")), ["bucket"])


def fingerprint_root(tree: DataFrame) -> DataFrame:
    """The one row (rows, total, mixed) that a tree adds up to."""
    return _summed(tree.select("rows", F.col("total").cast("decimal(38,0)").alias("total"), "mixed"), [])


def _summed(df: DataFrame, by: list[str]) -> DataFrame:
    whole = F.lit(str(1 << 64)).cast("decimal(38,0)")
    return df.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.coalesce(F.pmod(F.sum("total"), whole), F.lit(0)).cast("decimal(20,0)").alias("total"),
        F.coalesce(F.bit_xor("mixed"), F.lit(0)).cast("long").alias("mixed"))


def moved_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """(bucket) of the buckets in which two trees differ."""
    sums = F.struct("rows", "total", "mixed")
    old, new = before.select("bucket", sums.alias("old")), after.select("bucket", sums.alias("new"))
    return old.join(new, "bucket", "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select("bucket")


def moved_keys(before: DataFrame, after: DataFrame, trees: tuple[DataFrame, DataFrame] | None = None, record: str = "record", buckets: int = TREE_BUCKETS) -> DataFrame:
    """(key, change) of keys whose record was changed, added or removed between two versions of a base.

    Only rows of the buckets in which the trees differ are compared; where the versions agree that is none.
    """
    trees = trees or (fingerprint_tree(before, record, buckets), fingerprint_tree(after, record, buckets))
    differ = moved_buckets(*trees)

    def tagged(df: DataFrame, side: str, other: str) -> DataFrame:
        rows = df.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).join(differ, "bucket", "left_semi")
        return rows.select("key", etag(F.col(record)).alias(side), F.lit(None).cast("string").alias(other))

    both = tagged(before, "old", "new").unionByName(tagged(after, "new", "old")).groupBy("key").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("key", change.alias("change"))


# --- C9, C10 ---
def bulk_update(df: DataFrame, lines: DataFrame, keys: list[str], mode: str) -> tuple[DataFrame, DataFrame]:
    """(updated, failures) of a line-aligned update; ``updated`` is empty unless every key's lines are good.

    ``df``: keys, pos, value.  ``lines``: keys, pos, line.  Mode ``surface`` requires a parsing
    annotation over the same surface, ``marks`` paired marks.  Any failure of a key refuses the
    whole key, as does a different number of lines.
    """
    joined = df.join(lines, [*keys, "pos"], "full_outer").withColumn("line", strip(F.col("line")))
    common = F.when(F.col("value").isNull(), "extra line").when(F.col("line").isNull(), "missing line").when(F.col("line") == "", "empty")
    if mode == "surface":
        why = common.when(~annotation_ok(F.col("line")), "not an annotation").when(
            plain_surface(F.col("line")) != plain_surface(F.col("value")), "surface changes")
    else:
        why = common.when(F.length(F.regexp_replace("line", r"[^*]", "")) % 2 == 1, "unpaired marks")
    # read three times: by the failures, by the keys they refuse and by what is kept
    judged = checkpointed(joined.select(*keys, "pos", "line", why.alias("failure")))
    failures = judged.where("failure is not null").select(*keys, "pos", "failure")
    good = judged.join(failures.select(*keys).distinct(), keys, "left_anti")
    return good.select(*keys, "pos", F.col("line").alias("value")), failures


def rename_key(entries: DataFrame, renames: DataFrame, dependent: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(entries, dependent entries, refused).  Entries are (id, ord, key, value): the order stays.

    A rename (id, old, new) is refused when the new key exists in the entries, or when the old key is
    in the dependent map and the new one is there already.  Dependent keys follow.
    """
    asked = renames.where("old <> new").select("id", "old", "new")

    def has(rows: DataFrame, name: str, flag: str) -> DataFrame:
        return rows.select("id", F.col("key").alias(name)).distinct().withColumn(flag, F.lit(True))

    judged = asked.join(has(entries, "new", "_hit"), ["id", "new"], "left")
    bad = F.col("_hit").isNotNull()
    if dependent is not None:
        judged = judged.join(has(dependent, "old", "_dold"), ["id", "old"], "left").join(has(dependent, "new", "_dnew"), ["id", "new"], "left")
        bad = bad | (F.col("_dold").isNotNull() & F.col("_dnew").isNotNull())
    good = judged.where(~bad).select("id", F.col("old").alias("key"), "new")

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.join(good, ["id", "key"], "left").withColumn("key", F.coalesce("new", "key")).drop("new").select(*rows.columns)

    return renamed(entries), None if dependent is None else renamed(dependent), judged.where(bad).select("id", "old", "new")


def history(log: DataFrame, n: int = 60, key: str | None = None) -> DataFrame:
    """Newest saved edits first."""
    rows = log.where("status = 'saved'")
    if key is not None:
        rows = rows.where(F.col("key") == key)
    return rows.orderBy(F.desc("at"), F.asc("key"), F.desc("ord")).limit(n)
