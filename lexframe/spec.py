"""A dataset is a bundle of DataFrame functions; engine code takes the bundle, never a name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.functions.text import plain_surface
from lexframe.operators import contracts, project, publish, search, stats

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class NoteSpec:
    """One note type of a dataset and the function that makes its notes."""

    name: str
    cards: tuple[str, ...]
    build: Step


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    contract: Step
    sort: Step
    project: Step
    stats: Step
    terms: Step
    ranks: dict[str, int]
    fields: tuple[str, ...]
    notes: tuple[NoteSpec, ...] = field(default_factory=tuple)

    def checked(self, df: DataFrame) -> DataFrame:
        """The records, sorted and in field order, after the contract has passed."""
        from lexframe.operators.guards import gate

        gate(self.contract(df), self.name)
        return project.order_fields(self.sort(df), ["key", *self.fields])


def _leaf(c: Column, labels: dict[str, str], rest: str) -> Column:
    numbered = {key: f"{i}. {text}" for i, (key, text) in enumerate(labels.items(), 1)}
    return project.label(c, numbered, F.lit(rest))


def _packed(df: DataFrame, fields: tuple[str, ...]) -> Column:
    return publish.pack(F.struct("key", F.struct(*[c for c in fields if c in df.columns]).alias("record")))


# --- fixed values: record fields; the note fields, card groups and deck names in the functions below are fixed as well ---
_KANJI = ("tag", "variant", "except", "readings", "korean", "korean_src", "note")
_GRAMMAR = ("head", "page", "level", "gloss_ja", "gloss_en", "gloss_zh", "gloss_ko", "connect", "examples", "note_ja", "note_ko")
_VOCAB = ("list", "rank", "sfi", "band", "family", "senses")


def kanji_notes(df: DataFrame) -> DataFrame:
    fields = {"Kanji": F.col("key"), "Korean": F.array_join(F.flatten(F.map_values("korean")), " · "), "Variants": F.array_join(F.map_keys("variant"), " · "),
              "Tag": F.col("tag"), "Data": _packed(df, _KANJI)}
    return publish.note_rows(df, "kanji", fields, publish.sub_target("한자", {"읽기": "1. 읽기", "쓰기": "2. 쓰기"}, _leaf(F.col("tag"), project.TAG_LABELS, "9. 기타")))


def _grammar_fields(df: DataFrame) -> dict[str, Column]:
    return {"Grammar": F.col("head"), "Level": project.label(F.col("level"), stats.LEVELS), "Meaning": F.col("gloss_ko"),
            "Text": publish.search_text(F.col("examples")), "Data": _packed(df, _GRAMMAR)}


def _grammar_place(group: str) -> Column:
    return F.create_map(F.lit(publish.ANY_CARD), F.concat(F.lit(f"문법::{group}::"), project.label(F.col("level"), stats.LEVELS, F.lit("기타"))))


def grammar_notes(df: DataFrame) -> DataFrame:
    return publish.note_rows(df, "bunpo", {**_grammar_fields(df), "Connect": F.array_join("connect", " / "), "Note": F.col("note_ko")}, _grammar_place("1. 뜻"))


def grammar_example_notes(df: DataFrame) -> DataFrame:
    return publish.example_notes(df, "bunpo", _grammar_fields(df), _grammar_place("2. 작문"))


def vocab_notes(df: DataFrame) -> DataFrame:
    plain = F.transform("senses", lambda s: plain_surface(s["ja"]))
    lines = F.flatten(F.transform("senses", lambda s: F.filter(F.array(plain_surface(s["ja"]), s["gloss"]), lambda x: F.coalesce(x, F.lit("")) != "")))
    fields = {"Word": F.col("key"), "Japanese": F.array_join(plain, " · "), "Band": project.label(F.col("band"), project.BAND_LABELS), "Rank": F.col("rank"),
              "Text": F.array_join(lines, "<br>"), "Data": _packed(df, _VOCAB)}
    return publish.note_rows(df, "toeic", fields, publish.sub_target("토익", {"뜻": "1. 뜻", "철자": "2. 철자"}, _leaf(F.col("band"), project.BAND_LABELS, "9. 미분류")))


KANJI = DatasetSpec("kanji", contracts.validate_kanji, project.sort_kanji, project.project_kanji, stats.stats_kanji,
                    lambda df: search.kanji_terms(df, project.TAG_LABELS), search.KANJI_RANKS, _KANJI, (NoteSpec("kanji", ("읽기", "쓰기"), kanji_notes),))
GRAMMAR = DatasetSpec("grammar", contracts.validate_grammar, lambda df: df, project.project_grammar, stats.stats_grammar,
                      lambda df: search.grammar_terms(df, stats.LEVELS), search.GRAMMAR_RANKS, _GRAMMAR,
                      (NoteSpec("grammar", ("뜻",), grammar_notes), NoteSpec("grammar examples", ("작문",), grammar_example_notes)))
VOCAB = DatasetSpec("vocabulary", contracts.validate_vocab, lambda df: df, project.project_vocab, stats.stats_vocab,
                    lambda df: search.vocab_terms(df, project.BAND_LABELS), search.VOCAB_RANKS, _VOCAB, (NoteSpec("vocabulary", ("뜻", "철자"), vocab_notes),))
