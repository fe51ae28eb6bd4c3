"""Registered queries, one module per family."""

from __future__ import annotations

import importlib
from types import ModuleType

FAMILIES = (
    "funnel_queries",
    "bidreq_queries",
    "scalar_queries",
    "set_queries",
    "name_queries",
    "source_queries",
    "web_queries",
    "report_queries",
    "quality_queries",
    "feature_queries",
    "stream_queries",
    "ml_queries",
)


def load_all() -> ModuleType:
    """Import every family and return the filled registry."""
    for name in FAMILIES:
        importlib.import_module(f"adflow.plans.{name}")
    return importlib.import_module("adflow.plans.registry")
