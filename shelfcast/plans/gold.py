"""Gold: one row per store, product and day, with rolling features and the 7-day-ahead label."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.casting import hard_int, try_date, try_double, try_timestamp
from ..functions.flags import out_of_stock, parse_flag
from ..operators.filters import all_known
from ..operators.series import (
    HORIZON_DAYS,
    ROLLING_ROWS,
    change_over,
    horizon_frame,
    latest_per_key,
    rolling_frame,
    stockout_ahead,
    with_windows,
)
from ..schemas import GOLD_KEY, SERIES_KEY
from .silver import LOAD_TIME

# The columns of the gold table, in order.
GOLD_COLUMNS = [
    "store_id",
    "product_id",
    "ds",
    "title",
    "brand",
    "category",
    "location_name",
    "city",
    "state",
    "postal_code",
    "price",
    "listed_price",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "rating",
    "number_of_reviews",
    "available_to_promise_qty",
    "shipping_availability_status",
    "is_out_of_stock_in_all_stores",
    "is_sold_out",
    "shipping_method",
    "is_two_day_shipping",
    "is_base_shipping_method",
    "min_delivery_date",
    "max_delivery_date",
    "cutoff_time",
    "google_trend_score",
    "inv_7d_avg",
    "inv_7d_min",
    "inv_7d_max",
    "inv_7d_std",
    "price_change_7d",
    "rating_change_7d",
    "reviews_change_7d",
    "trend_7d_avg",
    "is_oos_today",
    "stockout_next_7d",
    "silver_load_ts",
    "gold_load_ts",
]

#: Days before the changed ones in which the rolling windows' rows are looked for first.
LOOKBACK_DAYS = 28

NUMBERS = [
    "price",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "rating",
    "number_of_reviews",
    "available_to_promise_qty",
    "google_trend_score",
]
FLAGS = [
    "is_out_of_stock_in_all_stores",
    "is_sold_out",
    "is_two_day_shipping",
    "is_base_shipping_method",
]
TEXTS = [
    "title",
    "brand",
    "category",
    "location_name",
    "city",
    "state",
    "postal_code",
    "shipping_availability_status",
    "shipping_method",
]


def daily_rows(silver: DataFrame) -> DataFrame:
    """Typed silver rows, the latest load of each store, product and day.

    Where silver carries the facts' own load times, the newest observation wins.
    """
    loaded = [LOAD_TIME] if LOAD_TIME in silver.columns else []
    typed = silver.filter(all_known("store_id", "product_id", "record_date")).select(
        hard_int("store_id").alias("store_id"),
        hard_int("product_id").alias("product_id"),
        F.col("record_date").cast("date").alias("ds"),
        *TEXTS,
        *[try_double(c).alias(c) for c in NUMBERS],
        *[parse_flag(c).alias(c) for c in FLAGS],
        try_date("min_delivery_date").alias("min_delivery_date"),
        try_date("max_delivery_date").alias("max_delivery_date"),
        try_timestamp("cutoff_time").alias("cutoff_time"),
        "silver_load_ts",
        *loaded,
    )
    newest = [*loaded, "silver_load_ts"]
    return latest_per_key(typed, GOLD_KEY, newest).drop(LOAD_TIME)


def gold_columns(series: WindowSpec, censor_empty: bool = False) -> dict[str, Column]:
    """All window columns of a series; one partitioning and one order, so one sort."""
    recent = rolling_frame(series)
    oos = out_of_stock("available_to_promise_qty", "is_sold_out", "is_out_of_stock_in_all_stores")
    return {
        "inv_7d_avg": F.avg("available_to_promise_qty").over(recent),
        "inv_7d_min": F.min("available_to_promise_qty").over(recent),
        "inv_7d_max": F.max("available_to_promise_qty").over(recent),
        "inv_7d_std": F.stddev_samp("available_to_promise_qty").over(recent),
        "trend_7d_avg": F.avg("google_trend_score").over(recent),
        "price_change_7d": change_over("price", series),
        "rating_change_7d": change_over("rating", series),
        "reviews_change_7d": change_over("number_of_reviews", series),
        "is_oos_today": oos,
        "stockout_next_7d": stockout_ahead(oos, horizon_frame(series), censor_empty),
    }


def featured_days(days: DataFrame, load_ts: Column, censor_empty: bool = False) -> DataFrame:
    """Gold rows of daily rows."""
    featured = with_windows(days, SERIES_KEY, "ds", lambda series: gold_columns(series, censor_empty))
    return (
        featured.withColumn("listed_price", F.col("price"))
        .withColumn("gold_load_ts", load_ts)
        .select(*GOLD_COLUMNS)
    )


def gold(silver: DataFrame, load_ts: Column, censor_empty: bool = False) -> DataFrame:
    """The gold table.

    Two shuffles: raw rows to their day (at most one row per key leaves a map task), then the
    remaining rows, one per day, to their series. A series is as long as the calendar, whatever
    share of the raw rows it had.
    """
    return featured_days(daily_rows(silver), load_ts, censor_empty)


def gold_of_days(
    silver: DataFrame,
    gold_rows: DataFrame,
    days: Sequence[dt.date],
    load_ts: Column,
    lookback_days: int = LOOKBACK_DAYS,
    censor_empty: bool = False,
) -> DataFrame:
    """The gold rows to replace after the silver rows of ``days`` have changed: whole days.

    A changed day alters the label of the ``HORIZON_DAYS`` before it and the windows of the rows
    after it, so everything from ``HORIZON_DAYS`` before the first changed day on is made again, for
    the series that have a row in ``days``; other series keep their rows. Both tables are partitioned
    by day, so older days are read for the ``ROLLING_ROWS`` rows before that only: from the last
    ``lookback_days`` days, and for a series with fewer rows there from all days before.
    """
    first = min(days) - dt.timedelta(days=HORIZON_DAYS)
    edge = first - dt.timedelta(days=lookback_days)
    touched = (
        silver.filter(F.col("record_date").isin(list(days)) & all_known("store_id", "product_id"))
        .select(*[hard_int(c).alias(c) for c in SERIES_KEY])
        .distinct()
    )
    fresh = daily_rows(silver.filter(F.col("record_date") >= F.lit(first)))
    columns = fresh.columns
    old = gold_rows.select(*columns)
    near = old.filter((F.col("ds") < F.lit(first)) & (F.col("ds") >= F.lit(edge))).join(
        touched, SERIES_KEY, "left_semi"
    )
    enough = near.groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= ROLLING_ROWS)
    short = touched.join(enough.select(*SERIES_KEY), SERIES_KEY, "left_anti")
    far = old.filter(F.col("ds") < F.lit(edge)).join(short, SERIES_KEY, "left_semi")
    newest = Window.partitionBy(*SERIES_KEY).orderBy(F.col("ds").desc())
    before = (
        near.unionByName(far)
        .withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= ROLLING_ROWS)
        .drop("_back")
    )
    # Fresh rows of other series meet theirs once, in the series' own shuffle, and go there.
    series = Window.partitionBy(*SERIES_KEY)
    rows = before.unionByName(fresh).withColumn("_touched", F.max(F.col("ds").isin(list(days))).over(series))
    made = featured_days(rows.filter("_touched").drop("_touched"), load_ts, censor_empty)
    kept = gold_rows.filter(F.col("ds") >= F.lit(first)).join(touched, SERIES_KEY, "left_anti")
    return made.filter(F.col("ds") >= F.lit(first)).unionByName(kept.select(*GOLD_COLUMNS))
