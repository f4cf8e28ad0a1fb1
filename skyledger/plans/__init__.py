"""Named plans: the alarm catalogue, the monthly composition and the registered queries."""

from __future__ import annotations

import importlib

_MODULES = (
    "cost_queries", "expression_queries", "inventory_queries", "metric_queries", "log_queries", "event_queries",
    "alarm_queries", "source_queries", "stream_queries",
)


def all_queries():
    """Every registered query by name."""
    from skyledger.plans.registry import REGISTRY

    for name in _MODULES:
        importlib.import_module(f"skyledger.plans.{name}")
    return REGISTRY
