"""All registered queries and their SQL."""

from __future__ import annotations

from corpusflow.plans import store_queries, text_queries, topic_queries, version_queries

_MODULES = (text_queries, topic_queries, store_queries, version_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
