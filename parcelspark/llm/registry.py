"""The queries opN_<name> and, where SQL can express them, their SQL."""

from __future__ import annotations

from parcelspark.llm import embeddings, language_model, mixing, packing, quality_classifier, quality_rules, simhash, substrings, token_counts, toxicity

_MODULES = (embeddings, language_model, mixing, packing, quality_classifier, quality_rules, simhash, substrings, token_counts, toxicity)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
