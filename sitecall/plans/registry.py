"""Registry of named queries: a Spark plan and, where SQL can express it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    survey_id: str


REGISTRY: dict[str, Query] = {}


def register(name: str, survey_id: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, survey_id)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills REGISTRY
    from sitecall.plans import site_queries  # noqa: F401
    from sitecall.plans import report_queries  # noqa: F401
    from sitecall.plans import read_queries  # noqa: F401
    from sitecall.plans import source_queries  # noqa: F401
    from sitecall.plans import gapped_queries  # noqa: F401

    return REGISTRY
