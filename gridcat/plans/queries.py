
from __future__ import annotations

from gridcat.plans import q_blocks, q_catalog, q_grid, q_layers, q_listing, q_pipelines, q_requests, q_scan, q_stream  # noqa: F401  (registers queries)
from gridcat.plans.registry import REGISTRY


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.oracle_sql() for name, q in REGISTRY.items() if q.oracle is not None}
