"""Every registered query: name, Spark callable and, where SQL can say it, the SQL for the second engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.registry.bound import Bound
from riskmart.registry.sql import compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def add(name: str, build: Callable[[Bound], DataFrame], sql: str | None = None) -> None:
    """Register ``build(bound tables)``; ``sql`` may mention any table of ``registry.sql``."""
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = lambda spark, sf_dir: build(Bound(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = compose(sql)


def load() -> None:
    """Import the query modules once."""
    from riskmart.registry import queries_models, queries_reports, queries_rules, queries_sources  # noqa: F401
