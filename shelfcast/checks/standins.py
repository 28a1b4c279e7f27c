"""Retail inputs derived from the supplied tables, in Spark and as SQL text for the same rows.

The supplied tables hold no stock data. ``events`` plays the daily silver rows (a user is a store, an
event type a product); ``lineitem`` with ``part``, ``supplier`` and ``orders`` plays the star join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.draws import uniform
from ..plans.gold import daily_rows, gold
from .registry import table

LOAD_TS = "2024-03-01 00:00:00"


def load_ts():
    return F.lit(LOAD_TS).cast("timestamp")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: engines add floats in different orders."""
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


# --- events as silver rows -------------------------------------------------------------------------


def events_k(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    k, step = F.col("k"), F.col("k") % 25
    day = F.col("ts").cast("date")
    low = F.col("value") < 5
    return events_k(spark, folder).select(
        F.col("user_id").alias("store_id"),
        F.conv(F.substring(F.md5("event_type"), 1, 7), 16, 10).alias("product_id"),
        F.col("event_type").alias("title"),
        F.concat(F.lit("brand_"), (k % 10).cast("string")).alias("brand"),
        F.col("event_type").alias("category"),
        (k % 6).alias("rating"),
        k.alias("number_of_reviews"),
        F.when(low, "0").otherwise("1").alias("availability"),
        F.concat(F.lit("store_"), F.col("user_id").cast("string")).alias("location_name"),
        F.concat(F.lit("city_"), (F.col("user_id") % 20).cast("string")).alias("city"),
        F.concat(F.lit("state_"), (F.col("user_id") % 5).cast("string")).alias("state"),
        F.lpad(F.col("user_id").cast("string"), 5, "0").alias("postal_code"),
        day.cast("string").alias("record_date"),
        F.date_add(day, k % 2 + 1).cast("string").alias("min_delivery_date"),
        F.date_add(day, k % 2 + 3).cast("string").alias("max_delivery_date"),
        day.cast("string").alias("cutoff_time"),
        F.when(k % 3 == 0, "standard").otherwise("express").alias("shipping_method"),
        F.when(k % 2 == 0, "Yes").otherwise("no").alias("is_two_day_shipping"),
        F.when(k % 4 == 0, "T").otherwise("f").alias("is_base_shipping_method"),
        F.when(step != 6, "no").alias("is_out_of_stock_in_all_stores"),
        F.when(k == 0, "true")
        .when(k == 25, "1")
        .when(k == 50, "yes")
        .when(k == 75, "T")
        .when(step == 1, F.lit(None))
        .when(step == 2, "")
        .when(step == 3, "No")
        .when(step == 4, "0")
        .when(step == 5, "maybe")
        .otherwise("false")
        .alias("is_sold_out"),
        F.when(low, "OUT_OF_STOCK").otherwise("IN_STOCK").alias("shipping_availability_status"),
        F.when(low, 0.0).otherwise(F.col("value")).alias("available_to_promise_qty"),
        F.col("value").alias("price"),
        (F.col("value") * 0.9).alias("current_retail_min"),
        (F.col("value") * 1.1).alias("current_retail_max"),
        (F.col("value") * 1.2).alias("reg_retail_min"),
        (F.col("value") * 1.3).alias("reg_retail_max"),
        k.alias("google_trend_score"),
        F.col("ts").alias("silver_load_ts"),
        "event_id",
    )


SILVER_SQL = """
fact AS (
  SELECT CAST(user_id AS INT) AS store_id,
    CAST('0x' || substr(md5(event_type), 1, 7) AS INT) AS product_id,
    event_type AS title, 'brand_' || CAST(k % 10 AS VARCHAR) AS brand, event_type AS category,
    k % 6 AS rating, k AS number_of_reviews,
    'store_' || CAST(user_id AS VARCHAR) AS location_name,
    'city_' || CAST(user_id % 20 AS VARCHAR) AS city,
    'state_' || CAST(user_id % 5 AS VARCHAR) AS state,
    lpad(CAST(user_id AS VARCHAR), 5, '0') AS postal_code,
    CAST(ts AS DATE) AS ds,
    CAST(ts AS DATE) + (k % 2 + 1) AS min_delivery_date,
    CAST(ts AS DATE) + (k % 2 + 3) AS max_delivery_date,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS cutoff_time,
    CASE WHEN k % 3 = 0 THEN 'standard' ELSE 'express' END AS shipping_method,
    (k % 2 = 0) AS is_two_day_shipping, (k % 4 = 0) AS is_base_shipping_method,
    CASE WHEN k % 25 <> 6 THEN FALSE END AS is_out_of_stock_in_all_stores,
    CASE WHEN k IN (0, 25, 50, 75) THEN TRUE WHEN k % 25 IN (1, 5) THEN NULL ELSE FALSE END AS is_sold_out,
    CASE WHEN value < 5 THEN 'OUT_OF_STOCK' ELSE 'IN_STOCK' END AS shipping_availability_status,
    CASE WHEN value < 5 THEN 0.0::DOUBLE ELSE value END AS available_to_promise_qty,
    value AS price,
    value * 0.9::DOUBLE AS current_retail_min, value * 1.1::DOUBLE AS current_retail_max,
    value * 1.2::DOUBLE AS reg_retail_min, value * 1.3::DOUBLE AS reg_retail_max,
    k AS google_trend_score, ts AS silver_load_ts, event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
)"""

# The daily rows: the latest load of each key and day.
DAILY_SQL = (
    SILVER_SQL
    + """,
daily AS (
  SELECT * EXCLUDE (latest) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, product_id, ds
                                 ORDER BY silver_load_ts DESC, event_id DESC) AS latest FROM fact) x
  WHERE latest = 1
)"""
)

# Rolling features, and the label by a self join over the next seven days.
ROLLED_SQL = """
rolled AS (
  SELECT *,
    avg(available_to_promise_qty) OVER last7 AS inv_7d_avg,
    min(available_to_promise_qty) OVER last7 AS inv_7d_min,
    max(available_to_promise_qty) OVER last7 AS inv_7d_max,
    stddev_samp(available_to_promise_qty) OVER last7 AS inv_7d_std,
    avg(CAST(google_trend_score AS DOUBLE)) OVER last7 AS trend_7d_avg,
    price - lag(price, 7) OVER series AS price_change_7d,
    CAST(rating AS DOUBLE) - lag(CAST(rating AS DOUBLE), 7) OVER series AS rating_change_7d,
    CAST(number_of_reviews AS DOUBLE) - lag(CAST(number_of_reviews AS DOUBLE), 7) OVER series
      AS reviews_change_7d,
    (COALESCE(available_to_promise_qty, 0) <= 0 OR is_sold_out OR is_out_of_stock_in_all_stores)
      AS is_oos_today
  FROM daily
  WINDOW series AS (PARTITION BY store_id, product_id ORDER BY ds),
         last7 AS (PARTITION BY store_id, product_id ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
),
ahead AS (
  SELECT a.store_id, a.product_id, a.ds,
    min(b.available_to_promise_qty) AS min_qty,
    max(CASE WHEN b.is_oos_today THEN 1 ELSE 0 END) AS any_oos,
    count(b.ds) AS later_rows
  FROM rolled a LEFT JOIN rolled b
    ON b.store_id = a.store_id AND b.product_id = a.product_id AND b.ds BETWEEN a.ds + 1 AND a.ds + 7
  GROUP BY a.store_id, a.product_id, a.ds
),
gold AS (
  SELECT r.*, r.price AS listed_price, (n.later_rows = 0 OR n.any_oos = 1) AS stockout_next_7d
  FROM rolled r JOIN ahead n USING (store_id, product_id, ds)
)"""
GOLD_SQL = f"{DAILY_SQL},{ROLLED_SQL}"

GOLD_DOUBLES = {
    "price",
    "listed_price",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "rating",
    "number_of_reviews",
    "available_to_promise_qty",
    "google_trend_score",
    "inv_7d_avg",
    "inv_7d_min",
    "inv_7d_max",
    "inv_7d_std",
    "price_change_7d",
    "rating_change_7d",
    "reviews_change_7d",
    "trend_7d_avg",
}


def gold_select(columns: list[str], source: str = "gold", ctes: str = GOLD_SQL) -> str:
    listed = ", ".join(
        f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in GOLD_DOUBLES else c for c in columns
    )
    return f"WITH {ctes} SELECT {listed} FROM {source}"


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily_rows(silver_rows(spark, folder))


def gold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return gold(silver_rows(spark, folder), load_ts())


# --- predictions: a repeatable probability per gold row ----------------------------------------------


def prediction_rows(spark: SparkSession, folder: str) -> DataFrame:
    proba = uniform("proba", "store_id", "product_id", "ds")
    return gold_rows(spark, folder).select(
        "store_id",
        "product_id",
        F.col("ds").alias("event_date"),
        F.col("stockout_next_7d").alias("stockout_label"),
        proba.alias("predicted_stockout_proba"),
        (proba >= 0.5).cast("int").alias("predicted_stockout_flag"),
    )


def sql_uniform(salt: str, *keys: str) -> str:
    joined = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws('|', {joined}, '{salt}')), 1, 8) AS BIGINT) / 4294967296.0)"


PREDICTIONS_SQL = (
    GOLD_SQL
    + f""",
predictions AS (
  SELECT store_id, product_id, event_date, stockout_label, predicted_stockout_proba,
    CAST(predicted_stockout_proba >= 0.5 AS INT) AS predicted_stockout_flag
  FROM (SELECT store_id, product_id, ds AS event_date, stockout_next_7d AS stockout_label,
          {sql_uniform('proba', 'store_id', 'product_id', 'ds')} AS predicted_stockout_proba FROM gold) p
)"""
)


def alert_log_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Keys already alerted: those whose digest starts with an even digit."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ("store_id", "product_id", "event_date")]))
    even = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int") % 2 == 0
    return (
        prediction_rows(spark, folder)
        .filter(even)
        .select("store_id", "product_id", "event_date", load_ts().alias("alert_sent_at"))
    )


LOG_SQL = """,
alert_log AS (
  SELECT store_id, product_id, event_date FROM predictions
  WHERE CAST('0x' || substr(md5(concat_ws('|', CAST(store_id AS VARCHAR), CAST(product_id AS VARCHAR),
        CAST(event_date AS VARCHAR))), 1, 1) AS INT) % 2 = 0
)"""
