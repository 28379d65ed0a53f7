"""The registered queries of the operators and their DuckDB text."""
from __future__ import annotations

from postwave.llm import (equal_average, exact_dedup, filter_audit, html_extract, language_id, line_dedup, lm, mixing,
                          ngram_join, packing, pivot_search, quality_rules, rule_ensemble)

_MODULES = {
    "op1_quality_rules": quality_rules,
    "op2_source_mixing": mixing,
    "op3_packing": packing,
    "op4_ngram_join": ngram_join,
    "op5_kneser_ney": lm,
    "op6_language_id": language_id,
    "op7_html_extract": html_extract,
    "op8_line_dedup": line_dedup,
    "op9_exact_dedup": exact_dedup,
    "op10_rule_ensemble": rule_ensemble,
    "op11_pivot_search": pivot_search,
    "op12_filter_audit": filter_audit,
    "op13_equal_average": equal_average,
}

QUERIES = {name: m.query for name, m in _MODULES.items()}
ORACLE = {name: m.SQL for name, m in _MODULES.items() if getattr(m, "SQL", None)}
