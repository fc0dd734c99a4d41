"""Column expressions; all of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def written_day(column: str | Column) -> Column:
    """Calendar day as written in ISO text; the offset behind it is ignored."""
    return _column(column).cast("date")


def instant(column: str | Column, strict: bool = True) -> Column:
    """ISO text as a point in time, honouring the offset.

    Text that is no timestamp raises when ``strict``, else gives NULL.
    """
    return F.to_timestamp(_column(column)) if strict else F.try_to_timestamp(_column(column))


def whole_second(column: str | Column) -> Column:
    return F.date_trunc("second", _column(column))


def day_number(column: str | Column) -> Column:
    """Days since 1970-01-01: a key that every table derives alike."""
    return F.unix_date(_column(column))


def endpoint_name(url: str | Column) -> Column:
    """Last path segment of a URL, without its query."""
    path = F.split_part(_column(url), F.lit("?"), F.lit(1))
    return F.split_part(path, F.lit("/"), F.lit(-1))


def mapped(column: str | Column, values: Mapping) -> Column:
    """Look a value up in a literal map; an unknown or NULL key gives NULL."""
    # Whole numbers of any width are looked up as 64-bit ones.
    keys = [F.lit(k).cast("bigint") if isinstance(k, int) else F.lit(k) for k in values]
    pairs = [item for k, v in zip(keys, values.values()) for item in (k, F.lit(v))]
    return F.create_map(*pairs)[_column(column)]


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
