"""Whole-warehouse wiring: lazy table graph, source bindings, query registry."""
