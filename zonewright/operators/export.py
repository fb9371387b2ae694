"""Shaping rows for a serving store, without bringing them to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from zonewright.functions.scalars import nan_to_null


def export_rows(
    df: DataFrame, columns: Sequence[str] | None = None, timestamp_format: str | None = None
) -> DataFrame:
    """Timestamps as text, NaN as null, only the named columns.

    Without a format, timestamps take Spark's text form (fraction only where there
    is one). Integers stay integers, nulls stay nulls.
    """

    def shaped(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = (
                F.date_format(column, timestamp_format)
                if timestamp_format
                else column.cast("string")
            )
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = nan_to_null(column)
        return column.alias(field.name)

    wanted = columns or df.columns
    return df.select(*[shaped(df.schema[name]) for name in wanted])
