"""The queries of this subpackage and the SQL that says the same, where SQL can."""

from __future__ import annotations

import importlib

#: Modules that hold QUERIES and, where SQL can express them, ORACLE_SQL.
MODULES = ("bpe", "token_count", "chat", "sharding", "quality", "url_filter", "decontamination", "jaccard_join", "suffix_dedup", "pii", "embedding_dedup", "prefix_trie", "centroids", "base")


def _all(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found |= getattr(importlib.import_module(f"boxloom.llm.{module}"), name, {})
    return found


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE_SQL")
