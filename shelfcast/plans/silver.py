"""Silver: fulfillment facts joined with product, price, store and search-interest data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casting import hard_int, int_of, try_date, try_double, try_timestamp
from ..functions.text import lowered, trimmed
from ..operators.filters import all_known, newer_than
from ..operators.joins import left_join, lookup_join, salted_left_join
from ..operators.series import latest_per_key

LOAD_TIME = "fact_load_ts"  # optional last column

# The columns of the silver table, in order.
SILVER_COLUMNS = [
    "store_id",
    "product_id",
    "title",
    "brand",
    "category",
    "rating",
    "number_of_reviews",
    "availability",
    "location_name",
    "city",
    "state",
    "postal_code",
    "record_date",
    "min_delivery_date",
    "max_delivery_date",
    "cutoff_time",
    "shipping_method",
    "is_two_day_shipping",
    "is_base_shipping_method",
    "is_out_of_stock_in_all_stores",
    "is_sold_out",
    "shipping_availability_status",
    "available_to_promise_qty",
    "scheduled_delivery_status",
    "scheduled_delivery_promise_qty",
    "charge_scheduled_delivery",
    "charge_one_day",
    "price",
    "is_current_price_range",
    "formatted_current_price_type",
    "formatted_comparison_price_type",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "cart_add_on_threshold",
    "formatted_current_price",
    "formatted_comparison_price",
    "google_trend_score",
    "silver_load_ts",
]


def clean_search(search: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in search.schema.fields}
    return search.filter(all_known("product_id")).select(
        hard_int("store_id").alias("store_id"),
        hard_int("product_id").alias("product_id"),
        trimmed("title").alias("title"),
        "brand",
        try_double("price").alias("price"),
        int_of("rating", types["rating"]).alias("rating"),
        int_of("reviews", types["reviews"]).alias("number_of_reviews"),
        lowered("availability").alias("availability"),
        "category",
        F.col("load_date").cast("date").alias("load_date"),
    )


def clean_fulfillment(fulfillment: DataFrame, with_load_time: bool = False) -> DataFrame:
    """``with_load_time`` carries each fact's own load time, which tells its observations apart."""
    loaded = [try_timestamp("load_timestamp").alias(LOAD_TIME)] if with_load_time else []
    return fulfillment.filter(all_known("store_id", "product_tcin")).select(
        hard_int("store_id").alias("store_id"),
        hard_int("product_tcin").alias("product_id"),
        try_date("record_date").alias("record_date"),
        try_date("min_delivery_date").alias("min_delivery_date"),
        try_date("max_delivery_date").alias("max_delivery_date"),
        try_timestamp("cutoff_time").alias("cutoff_time"),
        lowered("shipping_method_short_description").alias("shipping_method"),
        "is_two_day_shipping",
        "is_base_shipping_method",
        "is_out_of_stock_in_all_stores",
        "is_sold_out",
        "shipping_availability_status",
        "available_to_promise_qty",
        "scheduled_delivery_status",
        "scheduled_delivery_promise_qty",
        "charge_scheduled_delivery",
        "charge_one_day",
        *loaded,
    )


def clean_prices(prices: DataFrame) -> DataFrame:
    return prices.filter(all_known("product_id")).select(
        hard_int("store_id").alias("store_id"),
        hard_int("product_id").alias("product_id"),
        try_date("record_date").alias("record_date"),
        "is_current_price_range",
        "formatted_current_price_type",
        "formatted_comparison_price_type",
        "current_retail_min",
        "current_retail_max",
        "reg_retail_min",
        "reg_retail_max",
        "cart_add_on_threshold",
        "formatted_current_price",
        "formatted_comparison_price",
    )


def clean_stores(stores: DataFrame) -> DataFrame:
    return (
        stores.filter(all_known("store_id") & (F.trim(F.col("store_id").cast("string")) != ""))
        .select(
            hard_int("store_id").alias("store_id"),
            trimmed("location_name").alias("location_name"),
            "city",
            "state",
            "postal_code",
        )
        .distinct()
    )


def clean_trends(trends: DataFrame) -> DataFrame:
    score_type = trends.schema["interest_score"].dataType
    return trends.filter(all_known("interest_score")).select(
        F.col("dt").cast("date").alias("record_date"),
        int_of("interest_score", score_type).alias("google_trend_score"),
    )


def one_trend_a_day(trends: DataFrame, keyword: str | None = None, region: str | None = None) -> DataFrame:
    """At most one row a day: of the chosen keyword and region, or the highest interest of all."""
    rows = trends.filter(all_known("interest_score"))
    for column, value in (("keyword", keyword), ("region", region)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.groupBy(F.col("dt").cast("date").alias("dt")).agg(F.max("interest_score").alias("interest_score"))


def latest_prices(search: DataFrame) -> DataFrame:
    """The newest priced row of each product in a store, so that a price is drawn once a day."""
    priced = search.filter(all_known("price"))
    return latest_per_key(priced, ["store_id", "product_id"], ["load_timestamp"])


def silver(
    fulfillment: DataFrame,
    search: DataFrame,
    stores: DataFrame,
    trends: DataFrame,
    prices: DataFrame,
    load_ts: Column,
    latest_product_only: bool = False,
    after: dt.date | str | None = None,
    days: Sequence[dt.date | None] | None = None,
    with_load_time: bool = False,
) -> DataFrame:
    """The silver table, from the first fact row, past a watermark day, or of the given days (None: undated).

    Product search holds one row per load, so the join repeats a fact per load, unless
    ``latest_product_only`` keeps the latest load first.

    The two shuffled joins come first, the finer key before the one that may repeat rows; store and
    trend columns are looked up last, so they are never shuffled. A pair with much of the facts is
    salted for the product join: the latest product per pair already lies by the pair, so that AQE
    could not split it.
    """
    facts = clean_fulfillment(fulfillment, with_load_time)
    if days is not None:
        known = F.col("record_date").isin([d for d in days if d is not None])
        facts = facts.filter(known | F.col("record_date").isNull() if None in days else known)
    if after is not None:
        facts = newer_than(facts, "record_date", after)
    products = clean_search(search)
    if latest_product_only:
        products = latest_per_key(products, ["store_id", "product_id"], ["load_date"])
    joined = left_join(facts, clean_prices(prices), ["store_id", "product_id", "record_date"])
    products = products.drop("load_date")
    joined = salted_left_join(joined, products, ["store_id", "product_id"], counted=facts)
    joined = lookup_join(joined, clean_stores(stores), ["store_id"])
    joined = lookup_join(joined, clean_trends(trends), ["record_date"])
    columns = [*SILVER_COLUMNS, LOAD_TIME] if with_load_time else SILVER_COLUMNS
    return joined.withColumn("silver_load_ts", load_ts).select(*columns)
