"""The operators' queries over the whole test tables, by name, and the SQL of those that have one."""

from __future__ import annotations

from caselog.llm import chat, clustering, decontamination, language_model, lexical_search, packing, pii, quality_classifier, quality_rules, secrets, simhash, suffix_dedup, window_dedup
from caselog.llm.common import run_query

_MODULES = {
    "op1_pii": pii,
    "op2_chat": chat,
    "op3_decontamination": decontamination,
    "op4_packing": packing,
    "op5_simhash": simhash,
    "op6_language_model": language_model,
    "op7_quality_rules": quality_rules,
    "op8_suffix_dedup": suffix_dedup,
    "op9_quality_classifier": quality_classifier,
    "op10_secrets": secrets,
    "op11_lexical_search": lexical_search,
    "op12_clustering": clustering,
    "op13_substring_dedup": window_dedup,
}

QUERIES = {name: run_query(module.query) for name, module in _MODULES.items()}
ORACLES = {name: module.ORACLE.strip() for name, module in _MODULES.items() if hasattr(module, "ORACLE")}
