"""Rounding, bounds and filling of numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .casting import ColumnOrName, as_column


def round_to(value: ColumnOrName, digits: int) -> Column:
    return F.round(as_column(value), digits)


def round_to_half(value: ColumnOrName) -> Column:
    """Nearest 0.50, ties to the even step."""
    return F.bround(as_column(value) * 2, 0) / 2


def clip(value: ColumnOrName, low: float, high: float) -> Column:
    """Bounded value; NULL stays NULL (greatest and least alone would skip it)."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), column)))


def ordered_pair(first: ColumnOrName, second: ColumnOrName) -> tuple[Column, Column]:
    """Row-wise (smaller, larger); NULL if either side is NULL."""
    a, b = as_column(first), as_column(second)
    known = a.isNotNull() & b.isNotNull()
    return F.when(known, F.least(a, b)), F.when(known, F.greatest(a, b))


def finite_or_null(value: ColumnOrName) -> Column:
    """Infinities become NULL; other values, NaN too, are kept."""
    column = as_column(value)
    return F.when(F.abs(column) != float("inf"), column)


def sentinel_date(value: ColumnOrName, sentinel: str = "1900-01-01") -> Column:
    """Missing timestamps replaced by a fixed old day."""
    return F.coalesce(as_column(value), F.lit(sentinel).cast("timestamp_ntz"))
