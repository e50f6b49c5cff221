"""Query registry: name → (Spark callable, oracle SQL or None).

Each family module under ``tidewater.plans`` registers its queries with
``@query(name, sql)``. A callable takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole driver tables. ``sql`` is an independent DuckDB
statement over the same tables (views named after the tables); it is
``None`` only for randomised or model-fitting operators (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    family: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, family: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, family or fn.__module__.rsplit(".", 1)[-1])
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # importing the family modules fills the registry
    from tidewater.plans import load_all  # noqa: F401
    load_all()
    return dict(REGISTRY)
