"""Rules on arrays, maps and structs. All of them stay inside one row, so none
moves data between tasks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F


def parse_json(text: Column, schema: str) -> Column:
    """JSON text to the declared type; unreadable text gives null, a field of the
    wrong type gives a null field."""
    return F.from_json(text, schema)


def or_empty(values: Column, array_type: str) -> Column:
    return F.coalesce(values, F.array().cast(array_type))


def path(element: Column, dotted: str) -> Column:
    """Nested field ``a.b.c`` of a struct column."""
    for name in dotted.split("."):
        element = element.getField(name)
    return element


def pick_fields(values: Column, fields: Mapping[str, str | Column]) -> Column:
    """Array of structs to an array of other structs: output name to the path of
    the field it takes, or to a fixed column."""

    def reshape(element: Column) -> Column:
        return F.struct(
            *[
                (source if isinstance(source, Column) else path(element, source)).alias(name)
                for name, source in fields.items()
            ]
        )

    return F.transform(values, reshape)


def below_rank(values: Column, field: str, limit: int) -> Column:
    """Elements whose own rank field is under ``limit``."""
    return F.filter(values, lambda element: element.getField(field) < F.lit(limit))


def first_where(values: Column, matches: Callable[[Column], Column]) -> Column:
    """First element that matches, null when none does."""
    return F.get(F.filter(values, matches), F.lit(0))


def append_present(values: Column, element: Column) -> Column:
    """``values`` with ``element`` at the end, unless it is null."""
    return F.array_compact(F.array_append(values, element))


def first_across_pages(pages: Column, count: int) -> Column:
    """First ``count`` elements of an array of pages, in page order."""
    return F.slice(F.flatten(pages), 1, count)


def joined_text(text: Column, separator: str = "&") -> Column:
    """JSON list of texts as one text. A null list gives an empty text."""
    return F.coalesce(F.array_join(parse_json(text, "array<string>"), separator), F.lit(""))
