"""Registry of the queries and of the SQL that states the same results."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftstone import plans

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"query {name} is registered twice")
    _QUERIES[name] = query
    if sql is not None:
        _SQL[name] = sql


def _load() -> None:
    """Import every module of plans; each registers its queries."""
    for module in sorted(m.name for m in pkgutil.iter_modules(plans.__path__)):
        importlib.import_module(f"siftstone.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def FLAGSHIP(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: N802
    return queries()["ranked_candidates"](spark, sf_dir)
