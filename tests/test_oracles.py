"""Registered queries against DuckDB.  LEXFRAME_ALL=1 runs every query; the default is a spread of families."""

import os

import pytest

import __spark_entry__ as entry
from lexframe import plans
from tests.compare import compare, connect

FOLDER = os.environ.get("LEXFRAME_SF_DIR", "/root/testdata/sf0.001")
SOME = (
    "flagship_examples", "text_fold_kinds", "layout_lines", "layout_tail", "verify_readings", "align_candidates", "inflection_keys", "ledger_lookup", "apply_edits",
    "record_diff", "set_guards", "entry_keys", "pair_compare", "sync_plan", "packed_records", "sectioned_list", "payload_roundtrip",
    "gloss_lines", "word_containment", "lexicon_spots", "search_ranked", "wordlist_band", "edit_overlay", "base_drift", "stats_summary",
    "variant_tokens", "margin_arrows", "circled_items", "layout_ruby", "dictionary_gate", "mark_patterns", "residual_reading", "sort_examples",
)
CHOSEN = list(entry.queries()) if os.environ.get("LEXFRAME_ALL") else list(SOME)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_registry():
    queries, oracles = plans.all_queries(), plans.all_oracles()
    assert set(oracles) <= set(queries) and len(queries) - len(oracles) <= 2


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, duck, name):
    same, note = compare(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert same, note
