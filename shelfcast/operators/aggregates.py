"""Aggregates and one-row facts about a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NO_WATERMARK = "1900-01-01"  # fixed value: the watermark of an empty or absent table


def watermark(df: DataFrame | None, column: str, default: str = NO_WATERMARK) -> dt.date:
    """Latest day in a column; the default where there is no table or no row. Runs one aggregate."""
    fallback = dt.date.fromisoformat(default)
    if df is None:
        return fallback
    return df.agg(F.max(F.col(column).cast("date"))).first()[0] or fallback


def watermark_frame(df: DataFrame, column: str, default: str = NO_WATERMARK) -> DataFrame:
    latest = F.max(F.col(column).cast("date"))
    return df.agg(F.coalesce(latest, F.lit(default).cast("date")).alias("watermark"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; an empty result means the keys are unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, or an error if a key repeats. Runs the check."""
    first = duplicate_keys(df, keys).first()
    if first is not None:
        raise ValueError(f"key {keys} is not unique: {first.asDict()}")
    return df


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        *[f(c).alias(f"{label}_{c}") for c in columns for label, f in (("min", F.min), ("max", F.max))]
    )


def latest_row(df: DataFrame, created: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The latest row by a time column, per key or over all rows; ties go to the larger values.

    A max of structs: partial maxima are taken before the shuffle, so one hot key costs nothing.
    """
    carried = [c for c in columns if c != created]
    best = F.max(F.struct(created, *carried)).alias("best")
    grouped = df.groupBy(*by).agg(best) if by else df.agg(best).filter(F.col("best").isNotNull())
    return grouped.select(*by, *[F.col(f"best.{c}").alias(c) for c in columns])


def feature_stats(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Mean and population deviation of each column, as aggregates of one pass."""
    stats: list[Column] = []
    for name in columns:
        value = F.col(name).cast("double")
        stats += [F.avg(value).alias(f"{name}__mean"), F.stddev_pop(value).alias(f"{name}__std")]
    return stats


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, type, known values, rows. One pass over the data."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f"`{field.name}`")).alias("non_null"),
            F.count(F.lit(1)).alias("rows"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def label_window(df: DataFrame, keys: Sequence[str], qty: str, oos: str) -> DataFrame:
    """Per key: the lowest quantity and whether any row is out of stock (NULL counts as not)."""
    return df.groupBy(*keys).agg(
        F.min(qty).alias("min_qty"),
        F.max(F.when(F.col(oos), 1).otherwise(0)).alias("any_oos"),
    )
