"""Typed cleaning: which rows stay, which values become null, what is set aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from zonewright.functions import collections as C, scalars as S


def require_castable(df: DataFrame, column: str, type_name: str = "int") -> DataFrame:
    """Rows whose column casts, with the cast value in its place."""
    return df.withColumn(column, F.col(column).try_cast(type_name)).filter(
        F.col(column).isNotNull()
    )


def require_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column is neither null nor empty text."""
    return df.filter(reduce(lambda a, b: a & b, [S.is_filled(F.col(c)) for c in columns]))


def require_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where no column is null."""
    return df.dropna(subset=list(columns))


def require_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def require_elements(df: DataFrame, column: str) -> DataFrame:
    """Rows whose array is neither null nor empty."""
    return df.filter(F.size(column) > 0)


def recast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts in one projection; a value that does not cast becomes null."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def clean_entity(
    df: DataFrame,
    *,
    key: str,
    required_text: Sequence[str] = (),
    text: Sequence[str] = (),
    numbers: Sequence[str] = (),
    iso_date: str | None = None,
    joined_lists: Sequence[str] = (),
    key_type: str = "int",
) -> DataFrame:
    """Whole-record cleaning in one projection and one filter: castable key,
    required texts, typed texts and numbers, date shape, lists joined to text."""
    columns = {key: F.col(key).try_cast(key_type)}
    columns |= {c: F.col(c).cast("string") for c in [*required_text, *text]}
    columns |= {c: F.col(c).try_cast("double") for c in numbers}
    keep = [F.col(key).isNotNull(), *[S.is_filled(F.col(c)) for c in required_text]]
    if iso_date:
        columns[iso_date] = F.col(iso_date).cast("string")
        keep.append(S.iso_date_shaped(F.col(iso_date)))
    columns |= {c: C.joined_text(F.col(c)) for c in joined_lists}
    return df.withColumns(columns).filter(reduce(lambda a, b: a & b, keep))


def tag_rejects(
    df: DataFrame, rules: Mapping[str, Column], reason: str = "reject_reason"
) -> DataFrame:
    """Adds the name of the first rule a row breaks, null for a good row. A rule is
    a condition that is true for bad rows; null counts as not broken."""
    return df.withColumn(
        reason, F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    )


def split_quarantine(
    df: DataFrame, rules: Mapping[str, Column], reason: str = "reject_reason"
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reason. Together they are the input."""
    tagged = tag_rejects(df, rules, reason)
    return (
        tagged.filter(F.col(reason).isNull()).drop(reason),
        tagged.filter(F.col(reason).isNotNull()),
    )


def select_optional(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    rename: Mapping[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """The listed columns (name to type) that exist, under their new names.

    Absent ones are left out, or come as typed nulls when ``strict``.
    """
    rename = rename or {}
    chosen = []
    for name, type_name in columns.items():
        if name in df.columns:
            chosen.append(F.col(f"`{name}`").alias(rename.get(name, name)))
        elif strict:
            chosen.append(F.lit(None).cast(type_name).alias(rename.get(name, name)))
    return df.select(*chosen)


def in_range(
    df: DataFrame, column: str, first: Column, last: Column, equal: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows with ``first <= column <= last`` and the given equalities; all of it
    reaches the scan."""
    rows = df.filter(F.col(column).between(first, last))
    for name, value in (equal or {}).items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows
