"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def all_known(*columns: str) -> Column:
    """Conjunction of IS NOT NULL."""
    condition = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        condition = condition & F.col(name).isNotNull()
    return condition


def within(column: str, low, high, *known: str) -> Column:
    """BETWEEN, both ends included, with further columns required to be known."""
    condition = F.col(column).between(F.lit(low), F.lit(high))
    return condition & all_known(*known) if known else condition


def equals(column: str, value) -> Column:
    return F.col(column) == F.lit(value)


def one_of(column: Column | str, values: Sequence) -> Column:
    return (F.col(column) if isinstance(column, str) else column).isin(list(values))


def flagged_above(flag: str, proba: str, threshold: float) -> Column:
    return (F.col(flag) == 1) & (F.col(proba) >= threshold)


def newer_than(df: DataFrame, column: str, watermark: dt.date | str) -> DataFrame:
    """Rows past the watermark. On a table partitioned by the column this prunes partitions."""
    return df.filter(F.col(column) > F.lit(watermark).cast("date"))
