"""Registration of named queries and access to their input tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a function of ``(spark, folder)`` under ``name``."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, oracle)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table, as it is scanned."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
