"""Keyed upsert as a pure function of two frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from zonewright.operators.dedup import all_present
from zonewright.session import Staging


class DuplicateKeys(ValueError):
    """Several source rows carry the same non-null key."""


class MissingColumns(ValueError):
    """The source lacks columns the target has."""


def align(source: DataFrame, schema: T.StructType) -> DataFrame:
    """``source`` with the target's columns, order and types; other columns go."""
    missing = [f.name for f in schema.fields if f.name not in source.columns]
    if missing:
        raise MissingColumns(f"source lacks target columns {missing}")
    return source.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def merge_checked(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source does not have, and all source rows, for a source
    that is stored, and known not to repeat a key.

    Matched rows are replaced whole, unmatched ones inserted, nothing is deleted.
    A null in a key matches nothing, so such rows of both sides stay.

    Only the source's key columns enter the anti join. A small source is broadcast
    by Spark after a size check, and the target is then not shuffled at all;
    otherwise both sides are plain exchanges that AQE may split.
    """
    aligned = align(source, target.schema)
    changed = source.select(*keys).filter(all_present(keys))
    return target.join(changed, list(keys), "left_anti").select(*target.columns).unionByName(
        aligned
    )


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``merge_checked`` for any source: it is run once, into the session's shared folder,
    and a key that repeats in it raises ``DuplicateKeys``."""
    staged = Staging(target.sparkSession, "merge-source").put(align(source, target.schema))
    require_unique(staged, keys)
    return merge_checked(target, staged, keys)


def count_and_check(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count; raises ``DuplicateKeys`` when a full key repeats. One job that
    reads the key columns only and aggregates before its shuffle."""
    repeated = (F.col("n") > 1) & all_present(keys)
    row = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("rows"), F.count_if(repeated).alias("repeated"))
        .first()
    )
    if row["repeated"]:
        raise DuplicateKeys(f"{row['repeated']} keys over {list(keys)} repeat in the source")
    return row["rows"] or 0


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after checking that no full key repeats. Runs a job."""
    count_and_check(df, keys)
    return df
