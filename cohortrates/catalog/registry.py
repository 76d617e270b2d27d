"""All registered queries and their SQL."""

from __future__ import annotations

from . import preparation_queries, rate_queries, report_queries, result_queries

MODULES = [rate_queries, preparation_queries, result_queries, report_queries]

QUERIES = {name: pair for module in MODULES for name, pair in module.QUERIES.items()}
