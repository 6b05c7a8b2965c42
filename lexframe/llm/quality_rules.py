"""Quality rules: one table of thresholds compiled into one Spark projection.

Rules compare integers (``factor * measure`` against ``limit * base``), so a verdict never hangs on rounding.
No user function runs: words, windows and lines are handled by built-in array functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexframe.llm.common import SPACE_CHARS, SPACE_CLASS, let, named, packed_row, unpacked, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# --- fixed values: frequent function words of English, German, French and Spanish ---
STOP_WORDS = (
    "the of and to in is that for with by der die und das ist mit von den nicht ein "
    "le la les de des et un une que qui el los las en y es por para una"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``factor * measure`` lies ``over`` or ``under`` ``limit * base``."""

    name: str
    measure: str
    side: str
    limit: int
    base: str = ""
    factor: int = 1

    def fails(self, measures: Column) -> Column:
        left = F.lit(self.factor) * measures[self.measure]
        right = F.lit(self.limit) * measures[self.base] if self.base else F.lit(self.limit)
        return left > right if self.side == "over" else left < right

    def sql(self) -> str:
        right = f"{self.limit} * {self.base}" if self.base else str(self.limit)
        return f"{self.factor} * {self.measure} {'>' if self.side == 'over' else '<'} {right}"


BASE_RULES = (
    Rule("few_words", "n_words", "under", 50),
    Rule("repeated_windows", "n_repeat_words", "over", 50, "n_words", 100),
)
RULES = (
    Rule("many_symbols", "n_symbols", "over", 25, "n_words", 100),
    Rule("short_words", "word_chars", "under", 2, "n_words"),
    Rule("many_capitals", "n_capitals", "over", 40, "word_chars", 100),
    Rule("few_stop_words", "n_stop_words", "under", 1, "n_words", 100),
    Rule("repeated_lines", "n_dup_lines", "over", 50, "n_lines", 100),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_stop_words", "n_lines")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that stand at least twice in the array ``w``."""

    def covered(t: Column) -> Column:
        # windows with their place, sorted by window: equal windows stand next to each other
        placed = F.array_sort(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.array_sort(
            F.transform(
                F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["i"],
            )
        )
        lengths = lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x
        )
        return let(placed, lambda s: let(again(s), lengths))

    def from_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
        return let(windows, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(covered(t)))

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), from_hashes))


def measures(text: Column) -> Column:
    """A struct of MEASURES (long). Null and empty text measure 0 everywhere.

    Windows are compared by 64-bit hashes of 64-bit word hashes within one document.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))

    def counted(w: Column, x: Column) -> Column:
        found = {
            "n_words": F.size(w),
            "word_chars": F.length(F.translate(whole, SPACE_CHARS, "")),
            "n_symbols": _count_of(whole, SYMBOLS),
            "n_dup_lines": F.size(x) - F.size(F.array_distinct(x)),
            "n_repeat_words": _repeat_words(w),
            "n_capitals": _count_of(whole, CAPITALS),
            "n_stop_words": F.size(F.filter(w, lambda y: F.lower(y).isin(STOP_WORDS))),
            "n_lines": F.size(x),
        }
        return F.struct(*[found[m].cast("long").alias(m) for m in MEASURES])

    return let(words(text), lambda w: let(lines, lambda x: counted(w, x)))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct of MEASURES, ``failed_rules``, ``base_failed`` and ``kept``.

    All of it is one expression that binds the measures once, so a filter on the verdict, which the
    optimizer moves below the projection, costs no more than the verdict itself.
    """

    def judged(m: Column) -> Column:
        base = F.lit(False)
        for rule in BASE_RULES:
            base = base | rule.fails(m)
        failed = F.filter(F.array(*[F.when(r.fails(m), F.lit(r.name)) for r in (*BASE_RULES, *rules)]), lambda x: x.isNotNull())
        return let(failed, lambda f: F.struct(*[m[c].alias(c) for c in MEASURES], f.alias("failed_rules"), base.alias("base_failed"), (F.size(f) == 0).alias("kept")))

    return let(measures(text), judged)


def verdicts(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with measures, ``failed_rules`` (names in table order), ``base_failed`` and ``kept``.

    An empty table stays empty; repeated rows are judged alike; other columns pass unchanged, except
    that columns named like a result are replaced.
    """
    results = (*MEASURES, "failed_rules", "base_failed", "kept")
    own = [c for c in docs.columns if c.lower() not in results]
    judged = docs.select(packed_row(own).alias("row"), verdict(named(text), rules).alias("v"))
    return judged.select(*unpacked("row", own), *[F.col(f"v.{c}").alias(c) for c in results])


ORACLE = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACE_CLASS}]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SPACE_CLASS}]')) AS lines
  FROM documents),
tri AS (
  SELECT doc_id, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS t,
         unnest(range(1, len(words) - 1)) AS i
  FROM w WHERE len(words) >= 3),
twice AS (SELECT doc_id, t FROM tri GROUP BY ALL HAVING count(*) >= 2),
cover AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM tri JOIN twice USING (doc_id, t), (VALUES (0), (1), (2)) o(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(translate(text, '{CAPITALS}', '')))::BIGINT AS n_capitals,
         len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)})))::BIGINT AS n_stop_words,
         len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN cover USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({" OR ".join(r.sql() for r in BASE_RULES)}) AS base_failed,
       NOT ({" OR ".join(r.sql() for r in (*BASE_RULES, *RULES))}) AS kept
FROM m"""
