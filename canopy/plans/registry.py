"""Registry of named queries: ``name -> (spark builder, oracle SQL or None)``.

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Queries
without SQL get the weaker row-count check from the driver and their own
unit tests against a brute-force statement.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so its queries register."""
    from canopy.plans import (annotate_plans, preprocess_plans, record_plans,  # noqa: F401
                              stream_plans, topic_plans, vector_plans)
    return REGISTRY
