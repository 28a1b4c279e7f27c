"""Dashboard aggregates over gold rows and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.series import with_windows
from ..schemas import SERIES_KEY


def _share(flag: str):
    return F.avg(F.col(flag).cast("double"))


def pricing_trend(gold: DataFrame) -> DataFrame:
    return gold.groupBy("ds", "category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("price").alias("avg_price"),
        F.avg("current_retail_min").alias("avg_current_min"),
        F.avg("current_retail_max").alias("avg_current_max"),
        F.avg("price_change_7d").alias("avg_price_change_7d"),
    )


def availability(gold: DataFrame) -> DataFrame:
    """By store and day; rows whose state is unknown do not count in the rate."""
    return gold.groupBy("store_id", "ds").agg(
        F.count(F.lit(1)).alias("products"),
        F.count("is_oos_today").alias("products_known"),
        _share("is_oos_today").alias("oos_rate"),
        F.avg("available_to_promise_qty").alias("avg_qty"),
    )


def category_performance(gold: DataFrame) -> DataFrame:
    return gold.groupBy("category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("price").alias("avg_price"),
        F.avg("rating").alias("avg_rating"),
        F.avg("number_of_reviews").alias("avg_reviews"),
        _share("is_oos_today").alias("oos_rate"),
        _share("stockout_next_7d").alias("stockout_rate"),
    )


def riskiest_per_store(predictions: DataFrame, top: int = 5) -> DataFrame:
    """Top rows per store by probability; map tasks drop all but their own top rows first."""
    order = Window.partitionBy("store_id").orderBy(
        F.col("predicted_stockout_proba").desc_nulls_last(), "event_date", "product_id"
    )
    return (
        predictions.withColumn("risk_rank", F.row_number().over(order))
        .filter(F.col("risk_rank") <= top)
        .select("store_id", "risk_rank", "product_id", "event_date", "predicted_stockout_proba")
    )


def availability_shift(gold: DataFrame) -> DataFrame:
    """Did a product go out of stock, or come back, since its previous row?"""
    rows = with_windows(
        gold.select(*SERIES_KEY, "ds", "is_oos_today"),
        SERIES_KEY,
        "ds",
        lambda series: {"was_oos": F.lag("is_oos_today", 1).over(series)},
    )
    now, before = F.col("is_oos_today"), F.col("was_oos")
    shift = (
        F.when(now & ~before, "went_out").when(~now & before, "came_back").when(now == before, "same")
    )
    return rows.withColumn("availability_shift", shift)
