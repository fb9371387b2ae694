"""Distinct rows and one survivor per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "__rank"


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """DISTINCT over a projection; Spark aggregates partially before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()


def _tie_breakers(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [
        F.to_json(F.col(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
        for f in df.schema.fields
        if f.name not in keys
    ]


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    *,
    total_order: bool = True,
    for_skewed_join: bool = False,
) -> DataFrame:
    """One row per key: the first by ``order_by``, ties broken by all other columns.

    The outcome does not depend on how rows are spread. ``rank = 1`` right above
    the window lets Spark put a ``WindowGroupLimit`` before the shuffle: each map
    task sends at most one row per key, so a key that holds a third of all rows
    costs its reducer no more than one row per map task.

    Pass ``total_order=False`` when ``order_by`` alone already decides.

    ``for_skewed_join`` partitions by the keys wrapped in a struct. A join that
    follows then exchanges this side again (it is small by now), which gives AQE
    the two plain exchanges it needs to split a skewed partition of the other side.
    """
    order = [*order_by, *(_tie_breakers(df, keys) if total_order else [])] or [F.lit(1)]
    partition = [F.struct(*keys)] if for_skewed_join else list(keys)
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    )
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], count: int
) -> DataFrame:
    """The first ``count`` rows per key in a total order; trimmed before the shuffle
    like ``keep_one``."""
    window = Window.partitionBy(*keys).orderBy(*order_by, *_tie_breakers(df, keys))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= count).drop(_RANK)


def keep_one_present(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = (), **options: bool
) -> DataFrame:
    """``keep_one`` for rows with a full key; rows with a null in the key all stay,
    as a null never equals another."""
    present = all_present(keys)
    return keep_one(df.filter(present), keys, order_by, **options).unionByName(
        df.filter(~present)
    )
