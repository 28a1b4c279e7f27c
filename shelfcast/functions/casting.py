"""Casts with stated rounding and failure rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hard_int(value: ColumnOrName) -> Column:
    """Key cast: junk or overflow is an error, never a silent NULL."""
    return as_column(value).cast("int")


def try_double(value: ColumnOrName) -> Column:
    return as_column(value).try_cast("double")


def number_to_int(value: ColumnOrName) -> Column:
    """Double to int, half to even (2.5 -> 2, 3.5 -> 4); out of range is NULL."""
    return F.bround(as_column(value), 0).try_cast("int")


def text_to_int(value: ColumnOrName) -> Column:
    """Text to int, half away from zero ('2.5' -> 3, '-2.5' -> -3); junk is NULL."""
    return F.round(try_double(value), 0).try_cast("int")


def decimal_to_int(value: ColumnOrName) -> Column:
    """Decimal to int, half up."""
    return F.round(as_column(value), 0).try_cast("int")


def int_of(value: ColumnOrName, data_type: T.DataType) -> Column:
    """Rounding int cast, by the type the column has in its frame."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return number_to_int(value)
    if isinstance(data_type, T.DecimalType):
        return decimal_to_int(value)
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return text_to_int(value)
    return as_column(value).try_cast("int")


def try_date(value: ColumnOrName) -> Column:
    """Date from text, date or timestamp; '' and junk are NULL."""
    return as_column(value).try_cast("date")


def try_timestamp(value: ColumnOrName) -> Column:
    return as_column(value).try_cast("timestamp_ntz")


def text(value: ColumnOrName) -> Column:
    return as_column(value).cast("string")
