"""Registry of driver queries: name -> Spark builder + DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from gridcat.plans.views import with_views


@dataclass
class Query:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None
    views: list[str] = field(default_factory=list)

    def oracle_sql(self) -> str | None:
        return None if self.oracle is None else with_views(self.oracle, self.views)


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, oracle: str | None = None, views: list[str] | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` as a driver query.

    ``oracle`` is DuckDB SQL over the base tables plus the listed views (the
    view bodies are prepended as CTEs)."""
    def wrap(fn):
        REGISTRY[name] = Query(name, ids, fn, oracle, list(views or []))
        return fn
    return wrap
