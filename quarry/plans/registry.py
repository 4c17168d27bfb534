"""One registry for every registered query: builder + oracle SQL side by side.

``check`` follows SURVEY §2: E exact oracle, T oracle after rounding both sides,
R rows only (no SQL), P property test only (query still registered for rows).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    sql: str | None
    check: str
    ids: tuple[str, ...]


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, ids: str, sql: str | None = None, check: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    if check is None:
        check = "E" if sql else "R"

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, sql, check, tuple(ids.split()))
        return fn

    return deco


def all_queries() -> dict[str, QuerySpec]:
    from quarry.plans import catalog  # noqa: F401  (imports register every query module)

    return dict(REGISTRY)
