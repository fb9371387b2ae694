"""JSON text columns to child, dimension and bridge rows, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from zonewright.functions import collections as C
from zonewright.operators.dedup import keep_one

_CHILD = "__child"


class DimAndBridge(NamedTuple):
    dim: DataFrame
    bridge: DataFrame


def explode_children(
    df: DataFrame,
    parent: Sequence[str],
    column: str,
    schema: str | None,
    fields: Mapping[str, str | Column],
    *,
    outer: bool = False,
) -> DataFrame:
    """One row per array element with the parent's columns.

    ``column`` is JSON text of ``schema``, or an array already when ``schema`` is
    None. ``fields`` maps output names to element paths, or to a column written
    over ``child("path")``. A parent with no elements vanishes unless ``outer``.
    """
    values = F.col(column) if schema is None else C.parse_json(F.col(column), schema)
    explode = F.explode_outer if outer else F.explode
    rows = df.select(*parent, explode(values).alias(_CHILD))
    return rows.select(
        *parent,
        *[
            (source if isinstance(source, Column) else child(source)).alias(name)
            for name, source in fields.items()
        ],
    )


def child(dotted: str) -> Column:
    """A field of the element inside ``explode_children``."""
    return F.col(f"{_CHILD}.{dotted}")


def normalize_nested(
    links: DataFrame,
    *,
    dim_key: Sequence[str],
    dim_columns: Sequence[str],
    bridge_key: Sequence[str],
    bridge_columns: Sequence[str] = (),
    dim_order: Sequence[Column] = (),
    bridge_order: Sequence[Column] = (),
    required: Sequence[str] | None = None,
    required_dim: Sequence[str] | None = None,
) -> DimAndBridge:
    """Exploded links to a dimension (one row per ``dim_key``) and a bridge (one row
    per ``bridge_key``).

    Rows with a null in ``required`` (default: the dimension's key) are in
    neither; rows with a null in ``required_dim`` are only left out of the
    dimension. Dimension rows repeat many times over, so DISTINCT, a hash aggregate
    that already runs before the shuffle, comes first and ``keep_one`` then picks
    one variant per key. Bridge rows hardly repeat and take one shuffle only.
    """
    present = links.dropna(subset=list(required or dim_key))
    members = present.select(*dim_key, *dim_columns)
    if required_dim:
        members = members.dropna(subset=list(required_dim))
    dim = keep_one(members.distinct(), dim_key, dim_order)
    edges = present.select(*bridge_key, *bridge_columns)
    if bridge_columns:
        bridge = keep_one(edges, bridge_key, bridge_order)
    else:
        bridge = edges.distinct()
    return DimAndBridge(dim, bridge)


def unnest_map(
    df: DataFrame,
    parent: Sequence[str],
    column: Column,
    element_schema: str,
    *,
    outer_key: str,
    skip: Sequence[str] = (),
    key_name: str = "kind",
) -> DataFrame:
    """Two-level map ``outer key -> kind -> JSON list`` to one row per list element.

    ``column`` is a ``map<string,map<string,string>>``; only ``outer_key`` is read,
    kinds in ``skip`` are left out, and the kind becomes column ``key_name``.
    """
    inner = F.map_filter(
        F.try_element_at(column, F.lit(outer_key)), lambda kind, _: ~kind.isin(list(skip))
    )
    lists = df.select(*parent, F.explode(inner).alias(key_name, "__list"))
    rows = lists.select(
        *parent, key_name, F.explode(C.parse_json(F.col("__list"), element_schema)).alias(_CHILD)
    )
    names = [f.name for f in T.DataType.fromDDL(element_schema).elementType.fields]
    return rows.select(*parent, key_name, *[child(n).alias(n) for n in names])


def nested_list(
    column: Column, element_schema: str, *, outer_key: str, skip: Sequence[str], key_name: str
) -> Column:
    """The rows of ``unnest_map`` as one array per parent, without moving data."""
    inner = F.map_filter(
        F.try_element_at(column, F.lit(outer_key)), lambda kind, _: ~kind.isin(list(skip))
    )
    names = [f.name for f in T.DataType.fromDDL(element_schema).elementType.fields]

    def tagged(entry: Column) -> Column:
        elements = C.or_empty(C.parse_json(entry.getField("value"), element_schema), element_schema)
        return F.transform(
            elements,
            lambda e: F.struct(
                *[e.getField(n).alias(n) for n in names], entry.getField("key").alias(key_name)
            ),
        )

    return F.flatten(F.transform(F.map_entries(inner), tagged))


def encode_nested(df: DataFrame) -> DataFrame:
    """Every array, map or struct column as JSON text, the landing format."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.withColumns(
        {f.name: F.to_json(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, nested)}
    )


def decode_nested(df: DataFrame, schemas: Mapping[str, str]) -> DataFrame:
    """JSON text columns back to their declared types."""
    return df.withColumns({n: C.parse_json(F.col(n), s) for n, s in schemas.items()})
