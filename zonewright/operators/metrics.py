"""Row counts as quality metrics, in one pass or during a write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is collected while something else runs it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def quality_counts(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Rows ``(metric, n)`` from one scan. A metric is an aggregate expression."""
    totals = df.agg(*[m.cast("bigint").alias(name) for name, m in metrics.items()])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("n")) for n in metrics]
    return totals.select(F.inline(F.array(*pairs)))
