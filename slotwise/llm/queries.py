"""The registered corpus queries and their oracle SQL."""

from __future__ import annotations

import importlib

MODULES = {
    "op1_imatch": "imatch",
    "op2_quality_rules": "quality_rules",
    "op3_line_dedup": "line_dedup",
    "op4_benchmark_edits": "decontaminate",
    "op5_html_extract": "html_extract",
    "op6_best_fit": "packing",
    "op7_revisits": "warc",
    "op8_near_dedup": "near_dedup",
    "op9_toxicity": "toxicity",
    "op10_language_id": "language_id",
    "op11_divergence": "divergence",
    "op12_mixing": "mixing",
    "op13_filter_audit": "filter_audit",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"slotwise.llm.{m}"), name) for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    mods = {name: importlib.import_module(f"slotwise.llm.{m}") for name, m in MODULES.items()}
    return {name: m.SQL for name, m in mods.items() if getattr(m, "SQL", None)}
