"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("op1_decontaminate", "op2_adaptive_scan", "op3_maxent", "op4_packing", "op5_toxicity", "op6_jaccard", "op7_url_filter", "op8_fixity", "op9_preference", "op10_secrets")
_loaded = [import_module(f"annolith.llm.{name}") for name in MODULES]
QUERIES = {k: f for m in _loaded for k, f in m.QUERIES.items()}
SQL = {k: s for m in _loaded for k, s in m.SQL.items()}
