"""Scalar rules. Raw input is only ever cast with ``try_cast``: ANSI mode is on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Patterns raw text is checked against.
ISO_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
STARTS_WITH_DAY = r"^\d{4}-\d{2}-\d{2}"
URL_SHAPE = r"^(https?|ftp)://[^\s/$.?#].[^\s]*$"
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="


def whole_number(raw: Column, type_name: str = "int") -> Column:
    """Integer or null; ``'7.9'`` and out-of-range values are null."""
    return raw.try_cast(type_name)


def truncated_number(raw: Column, type_name: str = "int") -> Column:
    """Integer part of a decimal text, null where there is none."""
    return raw.try_cast("double").try_cast(type_name)


def grouped_number(raw: Column) -> Column:
    """``'1,868,413'`` to a bigint; anything that is no number is null."""
    return F.replace(raw.cast("string"), F.lit(","), F.lit("")).try_cast("bigint")


def decimal_number(raw: Column) -> Column:
    return raw.try_cast("double")


def amount_text(raw: Column, digits: int = 2) -> Column:
    """Number as grouped text with fixed decimals: ``1234.5`` to ``1,234.50``."""
    return F.format_number(raw.try_cast("double"), digits)


def is_filled(text: Column) -> Column:
    return text.isNotNull() & (text != F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def iso_date_shaped(text: Column) -> Column:
    """Shape only: ``2024-99-99`` passes. ``real_date`` also checks the calendar."""
    return text.rlike(ISO_DATE_SHAPE)


def real_date(text: Column) -> Column:
    return F.when(iso_date_shaped(text), F.try_to_date(text, "yyyy-MM-dd"))


def url_or_null(text: Column) -> Column:
    """The value where it has the shape of a URL, else a typed null; keeps the row."""
    return F.when(text.rlike(URL_SHAPE), text).otherwise(F.lit(None).cast("string"))


def instant(text: Column) -> Column:
    """ISO-8601 text to a timestamp, honouring ``Z`` and offsets, with or without
    fractions; unreadable text is null, and so is a time without its day."""
    return F.when(text.rlike(STARTS_WITH_DAY), F.try_to_timestamp(text))


def joined_key(*parts: Column | str) -> Column:
    """Parts joined by ``_``. Nulls are skipped, so two different tuples may give
    the same text: an output column, never what rows are matched on."""
    return F.concat_ws("_", *parts)


def url_parameter(url: Column, name: str = "v") -> Column:
    """Value of one query parameter of a URL, null where it is absent."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]+)", 1), F.lit(""))


def video_url(video_id: Column) -> Column:
    return F.concat(F.lit(VIDEO_URL_PREFIX), video_id)


def item_text(*parts: Column) -> Column:
    """Text that stands for one item, parts joined by `` - ``, nulls left out."""
    return F.concat_ws(" - ", *parts)


def window_start(as_of: str | date | Column, days: int = 7) -> Column:
    """First day of the window of ``days`` that ends at ``as_of``, as a date."""
    end = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return F.date_sub(end, days)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)
