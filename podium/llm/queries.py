"""Queries of the language-data problems, gathered for the driver."""

from __future__ import annotations

from podium.llm import match_queries, name_queries, text_queries

_MODULES = [name_queries, match_queries, text_queries]
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
