"""All registered plans: name -> Spark callable, and name -> DuckDB oracle SQL."""

from __future__ import annotations

import importlib

# plan modules, each exposing QUERIES (and SQL where an oracle exists)
MODULES = ["linkage", "dedup_plans", "records_plans", "keys_plans", "fuzzy_plans", "dictionary_plans", "extract_plans", "lookup_plans", "search_plans", "ladder_plans", "page_plans", "table_plans"]


def _modules():
    return [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def all_queries() -> dict:
    out = {}
    for mod in _modules():
        out.update(mod.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for mod in _modules():
        out.update(getattr(mod, "SQL", {}))
    return out
