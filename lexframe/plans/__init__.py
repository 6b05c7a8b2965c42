"""Registered queries: one module per operator family, each with QUERIES and ORACLES."""

from __future__ import annotations

import importlib

MODULES = ("flagship", "textual", "layouts", "aligning", "selecting", "curating", "auditing", "marks", "publishing", "sourcing", "datasets")


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(getattr(importlib.import_module(f"lexframe.plans.{name}"), attribute))
    return found


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
