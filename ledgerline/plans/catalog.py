"""All registered queries in inventory order."""

from __future__ import annotations

from . import queries_analytics, queries_files, queries_model, queries_quality, queries_relational, queries_reports  # noqa: F401  (registers on import)
from .registry import REGISTRY


def all_queries():
    return dict(sorted(REGISTRY.items()))
