"""Lookup joins. No side is hinted: Spark broadcasts one only after checking its
size, from statistics or, under AQE, from what the shuffle really wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonewright.functions import collections as C
from zonewright.operators.dedup import keep_one

_MATCHED = "__matched"
_ROW = "__row"
_TIMES = "__times"


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    right_order: Sequence[Column] = (),
    right_unique: bool = False,
    left_unique: bool = False,
) -> DataFrame:
    """Left (or inner) equi-join that never multiplies left rows.

    The right side is first reduced to one row per key, by ``right_order``, unless
    the caller knows it to be unique. Null keys match nothing.

    Skew: a left key that holds a large share of the rows is split by AQE. That
    needs a plain exchange on both sides, so the reduction is partitioned
    otherwise than the join (see ``keep_one``). Where the left side is unique by
    the key as well (``left_unique``) there is nothing to split, and the reduction
    and the join share one shuffle.
    """
    present = right.dropna(subset=list(on))
    lookup = (
        present
        if right_unique
        else keep_one(present, on, right_order, for_skewed_join=not left_unique)
    )
    return left.join(lookup, list(on), how)


def override_join(
    base: DataFrame,
    detail: DataFrame,
    on: Sequence[str],
    *,
    right_order: Sequence[Column] = (),
    right_unique: bool = False,
    left_unique: bool = False,
) -> DataFrame:
    """Left join where a matched detail row wins for every column both sides have,
    also where it holds null; columns only one side has are all kept."""
    shared = [c for c in detail.columns if c in base.columns and c not in on]
    marked = detail.select(
        *[F.col(c).alias(f"__d_{c}") if c in shared else F.col(c) for c in detail.columns],
        F.lit(True).alias(_MATCHED),
    )
    joined = lookup_join(
        base,
        marked,
        on,
        right_order=right_order,
        right_unique=right_unique,
        left_unique=left_unique,
    )
    return joined.withColumns(
        {c: F.when(F.col(_MATCHED), F.col(f"__d_{c}")).otherwise(F.col(c)) for c in shared}
    ).drop(_MATCHED, *[f"__d_{c}" for c in shared])


def dictionary_lookup(
    df: DataFrame,
    ids: str,
    dictionary: DataFrame,
    key: str,
    value: str,
    out: str,
    *,
    row_key: Sequence[str],
) -> DataFrame:
    """Array of ids to the array of their values, in the dictionary's key order;
    unknown ids are left out.

    Ids are exploded, looked up, and gathered again under the row's own ``row_key``.
    It has to be unique, nulls included, so that a gathered group is never longer than
    the row's own array; a row key that repeats is an error. The dictionary may be of
    any size: no side is hinted, and the plan is the same for all.
    """
    entries = keep_one(
        dictionary.select(key, value).dropna(subset=[key]), [key], for_skewed_join=True
    )
    row = F.struct(*row_key)
    lists = df.groupBy(row.alias(_ROW)).agg(
        F.count(F.lit(1)).alias(_TIMES), F.any_value(F.col(ids)).alias(ids)
    )
    once = F.when(F.col(_TIMES) == 1, F.col(ids)).otherwise(
        F.raise_error(F.concat(F.lit("row key repeats: "), F.to_json(_ROW)))
    )
    exploded = lists.select(_ROW, F.explode(F.array_distinct(once)).alias(key))
    gathered = (
        exploded.join(entries, key)
        .groupBy(_ROW)
        .agg(F.array_sort(F.collect_list(F.struct(key, value))).alias("__found"))
        .select(_ROW, F.col(f"__found.{value}").alias("__values"))
    )
    # structs with null fields are equal, so null row keys find their own values
    joined = df.withColumn(_ROW, row).join(gathered, _ROW, "left")
    value_array = f"array<{dictionary.schema[value].dataType.simpleString()}>"
    return joined.withColumn(out, C.or_empty(F.col("__values"), value_array)).drop(_ROW, "__values")
