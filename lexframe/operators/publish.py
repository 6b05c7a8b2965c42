"""Publishing: packed records, note rows, and the plan that reconciles them with an external store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import nfc_safe, plain_surface
from lexframe.operators.guards import duplicate_keys
from lexframe.operators.order import position

ANY_CARD = "*"
BATCH = 400


# --- S11 ---
def pack(envelope: Column) -> Column:
    """ASCII-safe payload of a record; the same record always gives the same text."""
    return F.translate(F.base64(F.encode(F.to_json(envelope), "UTF-8")), "\r\n", "")


def unpack(payload: Column, schema: str) -> Column:
    """Record of a payload; whitespace inside is tolerated."""
    return F.from_json(F.decode(F.unbase64(F.regexp_replace(payload, r"\s+", "")), "UTF-8"), schema)


def pack_records(df: DataFrame, record: list[str], derived: Column | None = None) -> DataFrame:
    envelope = F.struct("key", F.struct(*record).alias("record"), (F.struct() if derived is None else derived).alias("derived"))
    return df.withColumn("Data", pack(envelope))


# --- P1 ---
def sub_target(root: str, groups: dict[str, str], leaf: Column) -> Column:
    """Placement map: card name to its numbered target under the root."""
    return F.create_map(*[x for card, group in groups.items() for x in (F.lit(card), F.concat(F.lit(f"{root}::{group}::"), leaf))])


def note_rows(df: DataFrame, prefix: str, fields: dict[str, Column], placement: Column) -> DataFrame:
    """(key, fields, placement) of one note per row of ``df``."""
    named = F.create_map(*[x for name, value in fields.items() for x in (F.lit(name), F.coalesce(value.cast("string"), F.lit("")))])
    return df.select(F.concat(F.lit(f"{prefix}:"), F.col("key")).alias("key"), named.alias("fields"), placement.alias("placement"))


def example_notes(df: DataFrame, prefix: str, fields: dict[str, Column], placement: Column) -> DataFrame:
    """One note per example: the record narrowed to that example, keyed by record and position."""
    rows = df.select("*", F.posexplode("examples").alias("_at", "_x")).withColumn("position", F.col("_at") + 1)
    narrowed = rows.withColumn("examples", F.array("_x")).withColumn("key", F.concat("key", F.lit(":"), F.col("position").cast("string")))
    return note_rows(narrowed.drop("_at", "_x"), prefix, fields, placement)


def search_text(examples: Column, text: str = "ja", translation: str = "ko") -> Column:
    """Plain text of the examples, one line each, for searching in the store."""
    lines = F.flatten(F.transform(examples, lambda x: F.array_compact(F.array(plain_surface(x[text]), F.when(x[translation] != "", x[translation])))))
    return F.array_join(lines, "<br>")


# --- P2 - P5 ---
def broken_notes(notes: DataFrame) -> DataFrame:
    """Notes that must stop the plan: without a key, or sharing one (with a count)."""
    keyless = notes.where(F.col("key").isNull() | (F.col("key") == "")).select("key", F.lit("no key").alias("problem"))
    return keyless.unionByName(duplicate_keys(notes, ["key"]).select("key", F.lit("shared key").alias("problem")))


def field_changes(notes: DataFrame, existing: DataFrame) -> DataFrame:
    """(key, changed, before): fields whose stored form differs; a missing field counts as empty."""
    wanted = notes.select("key", F.explode("fields").alias("name", "value")).withColumn("value", nfc_safe(F.col("value")))
    stored = existing.select("key", F.explode("fields").alias("name", "old"))
    pairs = wanted.join(existing.select("key"), "key", "left_semi").join(stored, ["key", "name"], "left")
    different = pairs.where(~F.col("value").eqNullSafe(F.coalesce("old", F.lit(""))))
    entry = lambda c: F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", c))))
    return different.withColumn("old", F.coalesce("old", F.lit(""))).groupBy("key").agg(entry("value").alias("changed"), entry("old").alias("before"))


def card_targets(notes: DataFrame, existing: DataFrame, cards: DataFrame, names: DataFrame, default: str) -> DataFrame:
    """(key, card_id, deck, target) of every card of a known note.

    ``cards``: card_id, note_id, ord, deck.  ``names``: ord, name (the few card names of a note type).
    """
    known = notes.select("key", "placement").join(existing.select("key", "note_id"), "key")
    placed = cards.join(known, "note_id").join(names, "ord", "left")
    target = F.coalesce(F.try_element_at("placement", F.coalesce("name", F.lit(""))), F.try_element_at("placement", F.lit(ANY_CARD)), F.lit(default))
    return placed.select("key", "card_id", "deck", target.alias("target"))


def plan_moves(targets: DataFrame) -> DataFrame:
    return targets.where((F.col("target") != "") & (F.col("deck") != F.col("target")))


def plan_sync(notes: DataFrame, existing: DataFrame, moves: DataFrame | None = None) -> DataFrame:
    """(key, note_id, action, changed, before); actions add, update, unchanged, moved, stale.

    A note whose fields agree but one of whose cards is misplaced is ``moved``, not unchanged.
    """
    both = notes.select("key", F.lit(True).alias("_want")).join(existing.select("key", "note_id"), "key", "full_outer")
    planned = both.join(field_changes(notes, existing), "key", "left")
    action = F.when(F.col("_want").isNull(), "stale").when(F.col("note_id").isNull(), "add").when(F.col("changed").isNotNull(), "update")
    if moves is not None:
        off = moves.select("key", F.lit(True).alias("_off")).distinct()
        planned = planned.join(off, "key", "left")
        action = action.when(F.col("_off"), "moved")
    return planned.select("key", "note_id", action.otherwise("unchanged").alias("action"), "changed", "before")


def plan_targets(plan: DataFrame, notes: DataFrame, moves: DataFrame, existing_targets: DataFrame) -> DataFrame:
    """Targets to create before anything is sent: those of new notes and of moves that do not exist yet."""
    fresh = notes.join(plan.where("action = 'add'").select("key"), "key", "left_semi").select(F.explode(F.map_values("placement")).alias("target"))
    return fresh.unionByName(moves.select("target")).distinct().join(existing_targets, "target", "left_anti")


def plan_batches(rows: DataFrame, target: str, order: list[str], bucket: Column, size: int = BATCH) -> DataFrame:
    """Adds the batch of every row inside its target."""
    placed = position(rows, [target], order, bucket, "_n")
    return placed.withColumn("batch", F.floor((F.col("_n") - 1) / size)).drop("_n")


def place_new(plan: DataFrame, notes: DataFrame, names: DataFrame, default: str) -> DataFrame:
    """(key, ord, target) of the cards of new notes that cannot be created in place: all but the first."""
    fresh = notes.join(plan.where("action = 'add'").select("key"), "key", "left_semi")
    # the card names of a note type: a handful by definition, carried as one value
    later = names.where("ord > 0").agg(F.sort_array(F.collect_list(F.struct("ord", "name")))).scalar()
    listed = fresh.withColumn("_later", later).select("*", F.inline("_later"))
    target = F.coalesce(F.try_element_at("placement", F.col("name")), F.try_element_at("placement", F.lit(ANY_CARD)), F.lit(default))
    return listed.select("key", "ord", target.alias("target"))


def plan_summary(plan: DataFrame, moves: DataFrame, new_targets: DataFrame) -> DataFrame:
    """One row: add, update, move, unchanged, stale, new_targets."""
    actions = plan.agg(*[F.count_if(F.col("action") == a).alias(a) for a in ("add", "update", "unchanged", "stale")])
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return actions.withColumn("_k", F.lit(0)).join(one(moves, "move").withColumn("_k", F.lit(0)), "_k").join(
        one(new_targets, "new_targets").withColumn("_k", F.lit(0)), "_k").drop("_k")
