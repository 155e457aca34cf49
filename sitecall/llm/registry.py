"""Registry of the text-operator queries: a Spark plan and, where SQL can express it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sitecall.llm.common import prepare


@dataclass(frozen=True)
class LlmQuery:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, LlmQuery] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = LlmQuery(name, fn, oracle)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> dict[str, LlmQuery]:
    # importing the module fills QUERIES
    from sitecall.llm import queries  # noqa: F401

    return QUERIES
