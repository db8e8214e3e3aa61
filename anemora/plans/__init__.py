"""Multi-step plans and the registered queries."""

from __future__ import annotations

import importlib

_MODULES = ("label_queries", "series_queries", "estimator_queries", "comparison_queries", "stream_queries")


def load_queries():
    """Import the query modules and return ``(queries, sql)``."""
    for module in _MODULES:
        importlib.import_module(f"anemora.plans.{module}")
    from anemora.plans.registry import QUERIES, SQL

    return QUERIES, SQL
