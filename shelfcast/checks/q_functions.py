"""Scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import casting, flags, numeric, text
from ..operators.columns import fill_by_type
from .registry import query, table
from .standins import PREDICTIONS_SQL, SILVER_SQL, prediction_rows, silver_rows


@query("f1_hard_int", "SELECT l_orderkey, CAST(l_suppkey AS INT) AS store_id FROM lineitem")
def hard_int(spark, folder):
    rows = table(spark, folder, "lineitem")
    return rows.select("l_orderkey", casting.hard_int("l_suppkey").alias("store_id"))


@query(
    "f2_try_double",
    "SELECT p_partkey, TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS price, "
    "TRY_CAST(p_name AS DOUBLE) AS junk, TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS size FROM part",
)
def try_double(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        casting.try_double(F.col("p_retailprice").cast("string")).alias("price"),
        casting.try_double("p_name").alias("junk"),
        casting.try_double(F.col("p_size").cast("string")).alias("size"),
    )


@query(
    "f3_rounding_int",
    "SELECT p_partkey, TRY_CAST(p_size / 2.0::DOUBLE AS INT) AS from_double, "
    "TRY_CAST(CAST(p_size / -2.0::DOUBLE AS VARCHAR) AS INT) AS from_text, "
    "TRY_CAST(p_name AS INT) AS from_junk, "
    "CAST(CAST(p_size / 2.0 AS DECIMAL(10, 1)) AS INT) AS from_decimal FROM part",
)
def rounding_int(spark, folder):
    half = F.col("p_size") / F.lit(2.0)
    return table(spark, folder, "part").select(
        "p_partkey",
        casting.number_to_int(half).alias("from_double"),
        casting.text_to_int((-half).cast("string")).alias("from_text"),
        casting.text_to_int("p_name").alias("from_junk"),
        casting.decimal_to_int(half.cast("decimal(10,1)")).alias("from_decimal"),
    )


@query(
    "f4_try_date",
    "SELECT o_orderkey, TRY_CAST(CAST(o_orderdate AS VARCHAR) AS DATE) AS from_time_text, "
    "TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS from_day_text, "
    "TRY_CAST(o_orderpriority AS DATE) AS from_junk, CAST(o_orderdate AS DATE) AS from_time FROM orders",
)
def try_date(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        casting.try_date(F.col("o_orderdate").cast("string")).alias("from_time_text"),
        casting.try_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("from_day_text"),
        casting.try_date("o_orderpriority").alias("from_junk"),
        casting.try_date("o_orderdate").alias("from_time"),
    )


@query(
    "f5_try_timestamp",
    "SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS from_text, "
    "TRY_CAST(event_type AS TIMESTAMP) AS from_junk FROM events",
)
def try_timestamp(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        casting.try_timestamp(F.col("ts").cast("string")).alias("from_text"),
        casting.try_timestamp("event_type").alias("from_junk"),
    )


@query("f6_text", "SELECT CAST(l_partkey AS VARCHAR) AS product_id, l_orderkey FROM lineitem")
def as_text(spark, folder):
    rows = table(spark, folder, "lineitem")
    return rows.select(casting.text("l_partkey").alias("product_id"), "l_orderkey")


@query("f7_lower", "SELECT p_partkey, lower(p_brand) AS brand, lower(CAST(p_size AS VARCHAR)) AS size FROM part")
def lowered(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.lowered("p_brand").alias("brand"), text.lowered("p_size").alias("size")
    )


@query(
    "f8_trim",
    "SELECT p_partkey, chr(9) || ' ' || p_name AS trimmed, p_name AS stripped FROM part",
)
def trimmed(spark, folder):
    padded = F.concat(F.lit("\t "), "p_name", F.lit("  "))
    return table(spark, folder, "part").select(
        "p_partkey", text.trimmed(padded).alias("trimmed"), text.stripped(padded).alias("stripped")
    )


@query(
    "f9_coalesce",
    f"WITH {SILVER_SQL} SELECT event_id, COALESCE(is_out_of_stock_in_all_stores, TRUE) AS known FROM fact",
)
def coalesced(spark, folder):
    parsed = flags.parse_flag("is_out_of_stock_in_all_stores")
    return silver_rows(spark, folder).select(
        "event_id", F.coalesce(parsed, F.lit(True)).alias("known")
    )


@query(
    "f10_searched_case",
    "SELECT p_partkey, CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1000 THEN 'middle' "
    "ELSE 'high' END AS band FROM part",
)
def searched_case(spark, folder):
    price = F.col("p_retailprice")
    band = F.when(price < 950, "low").when(price < 1000, "middle").otherwise("high")
    return table(spark, folder, "part").select("p_partkey", band.alias("band"))


@query("f11_current_time")
def current_time(spark, folder):
    """Rows stamped with the run's time: a function by default, a parameter in the jobs."""
    return table(spark, folder, "part").select(
        "p_partkey",
        F.current_timestamp().alias("load_timestamp"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingested_at"),
    )


@query("f11_stamp_of_the_run", "SELECT p_partkey, TRUE AS in_time, TRUE AS text_agrees FROM part")
def stamp_of_the_run(spark, folder):
    """The stamp is not before the run's start nor more than a day later; its text is the same second."""
    start = dt.datetime.now(dt.timezone.utc)
    rows = current_time(spark, folder)
    stamp = F.col("load_timestamp")
    text = F.to_timestamp("ingested_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        "p_partkey",
        ((stamp >= F.lit(start)) & (stamp < F.lit(start + dt.timedelta(days=1)))).alias("in_time"),
        (text == F.date_trunc("second", stamp)).alias("text_agrees"),
    )


@query(
    "f12_date_arithmetic",
    "SELECT l_orderkey, CAST(l_shipdate AS DATE) + 7 AS next_week, CAST(l_shipdate AS DATE) - 6 AS week_start, "
    "CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INT) AS days FROM lineitem",
)
def date_arithmetic(spark, folder):
    day = F.col("l_shipdate").cast("date")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.date_add(day, 7).alias("next_week"),
        F.date_sub(day, 6).alias("week_start"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days"),
    )


@query(
    "f13_difference",
    "SELECT l_orderkey, l_partkey, round(l_discount - l_tax, 6) AS change FROM lineitem",
)
def difference(spark, folder):
    change = F.round(F.col("l_discount") - F.col("l_tax"), 6)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", change.alias("change"))


FLAG_NAMES = [
    "is_sold_out",
    "is_out_of_stock_in_all_stores",
    "is_two_day_shipping",
    "is_base_shipping_method",
]


@query("f14_parse_flag", f"WITH {SILVER_SQL} SELECT event_id, {', '.join(FLAG_NAMES)} FROM fact")
def parse_flag(spark, folder):
    parsed = [flags.parse_flag(c).alias(c) for c in FLAG_NAMES]
    return silver_rows(spark, folder).select("event_id", *parsed)


@query(
    "f15_out_of_stock",
    f"WITH {SILVER_SQL} SELECT event_id, (COALESCE(available_to_promise_qty, 0) <= 0 OR is_sold_out "
    "OR is_out_of_stock_in_all_stores) AS is_oos_today FROM fact",
)
def out_of_stock(spark, folder):
    oos = flags.out_of_stock(
        "available_to_promise_qty",
        flags.parse_flag("is_sold_out"),
        flags.parse_flag("is_out_of_stock_in_all_stores"),
    )
    return silver_rows(spark, folder).select("event_id", oos.alias("is_oos_today"))


@query(
    "f16_item_url",
    "SELECT p_partkey, 'https://shop.example/p/' || CAST(p_partkey AS VARCHAR) AS url FROM part",
)
def item_url(spark, folder):
    url = text.item_url("https://shop.example/p/", "p_partkey")
    return table(spark, folder, "part").select("p_partkey", url.alias("url"))


@query(
    "f17_clean_id",
    "SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS from_float, CAST(l_suppkey AS VARCHAR) AS from_int "
    "FROM lineitem",
)
def clean_id(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        text.clean_id(F.col("l_partkey").cast("double").cast("string")).alias("from_float"),
        text.clean_id("l_suppkey").alias("from_int"),
    )


@query(
    "f18_address",
    "SELECT c_custkey, concat_ws(', ', trim(c_name), CASE WHEN c_nationkey % 3 > 0 THEN n_name END, "
    "CASE c_nationkey % 2 WHEN 0 THEN '' ELSE c_mktsegment END) AS address "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def address(spark, folder):
    nation = table(spark, folder, "nation")
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    parts = [
        F.concat(F.lit(" "), "c_name", F.lit("\t")),
        F.when(F.col("c_nationkey") % 3 > 0, F.col("n_name")).otherwise(""),
        F.when(F.col("c_nationkey") % 2 == 0, "  ").otherwise(F.col("c_mktsegment")),
    ]
    return rows.select("c_custkey", text.address_line(parts).alias("address"))


@query(
    "f19_business_key",
    "SELECT c_custkey, CASE WHEN c_nationkey % 4 > 0 THEN CAST(c_custkey AS VARCHAR) "
    "ELSE 'addr_' || substr(sha256(c_name), 1, 32) END AS business_key FROM customer",
)
def business_key(spark, folder):
    store = F.when(F.col("c_nationkey") % 4 > 0, F.col("c_custkey").cast("string")).when(
        F.col("c_nationkey") % 8 == 0, "  "
    )
    key = text.business_key(store, "c_name")
    return table(spark, folder, "customer").select("c_custkey", key.alias("business_key"))


@query(
    "f20_rounding",
    "SELECT l_orderkey, l_partkey, round_even(l_extendedprice * 2, 0) / 2 AS to_half, "
    "round(l_extendedprice / 7, 2) AS to_cents FROM lineitem",
)
def rounding(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        numeric.round_to_half("l_extendedprice").alias("to_half"),
        numeric.round_to(F.col("l_extendedprice") / 7, 2).alias("to_cents"),
    )


@query(
    "f21_clip",
    "SELECT l_orderkey, l_partkey, greatest(10.0::DOUBLE, least(40.0::DOUBLE, l_quantity)) AS clipped "
    "FROM lineitem",
)
def clip(spark, folder):
    clipped = numeric.clip("l_quantity", 10.0, 40.0)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", clipped.alias("clipped"))


@query(
    "f22_ordered_pair",
    "SELECT l_orderkey, l_partkey, least(l_discount, l_tax) AS low, greatest(l_discount, l_tax) AS high "
    "FROM lineitem",
)
def ordered_pair(spark, folder):
    low, high = numeric.ordered_pair("l_discount", "l_tax")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", low.alias("low"), high.alias("high")
    )


@query(
    "f23_price_text",
    "SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber % 2 = 0 "
    "THEN printf('$%.2f - $%.2f', l_extendedprice, l_extendedprice + 1) "
    "ELSE printf('$%.2f', l_extendedprice) END AS label FROM lineitem",
)
def price_text(spark, folder):
    high = F.col("l_extendedprice") + 1
    label = text.price_text("l_extendedprice", high, F.col("l_linenumber") % 2 == 0)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", label.alias("label"))


@query(
    "f24_fill_by_type",
    f"WITH {SILVER_SQL} SELECT event_id, COALESCE(is_sold_out, FALSE) AS flag, "
    "COALESCE(CASE WHEN is_sold_out IS NOT NULL THEN available_to_promise_qty END, 0) AS qty, "
    "COALESCE(CASE WHEN is_sold_out IS NOT NULL THEN title END, '') AS title FROM fact",
)
def filled_by_type(spark, folder):
    flag = flags.parse_flag("is_sold_out")
    rows = silver_rows(spark, folder).select(
        "event_id",
        flag.alias("flag"),
        F.when(flag.isNotNull(), F.col("available_to_promise_qty")).alias("qty"),
        F.when(flag.isNotNull(), F.col("title")).alias("title"),
    )
    return fill_by_type(rows)


@query(
    "f25_infinite_to_null",
    "SELECT l_orderkey, l_partkey, CASE WHEN l_discount > 0 THEN l_discount END AS discount FROM lineitem",
)
def infinite_to_null(spark, folder):
    value = F.when(F.col("l_discount") > 0, F.col("l_discount")).otherwise(
        F.when(F.col("l_tax") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    )
    finite = numeric.finite_or_null(value)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", finite.alias("discount"))


@query(
    "f26_sentinel_date",
    "SELECT event_id, CASE WHEN value >= 5 THEN ts ELSE TIMESTAMP '1900-01-01 00:00:00' END AS cutoff_time "
    "FROM events",
)
def sentinel_date(spark, folder):
    written = F.when(F.col("value") >= 5, F.col("ts").cast("string")).otherwise(F.col("event_type"))
    cutoff = numeric.sentinel_date(casting.try_timestamp(written))
    return table(spark, folder, "events").select("event_id", cutoff.alias("cutoff_time"))


@query(
    "f27_null_guard",
    "SELECT l_orderkey, l_partkey, CASE WHEN l_tax > 0 THEN round_even(l_quantity * 1.1::DOUBLE * 2, 0) / 2 END "
    "AS varied, CASE WHEN l_tax > 0 THEN least(5.0::DOUBLE, l_quantity) END AS clipped FROM lineitem",
)
def null_guard(spark, folder):
    base = F.when(F.col("l_tax") > 0, F.col("l_quantity"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        numeric.round_to_half(base * 1.1).alias("varied"),
        numeric.clip(base, 0.0, 5.0).alias("clipped"),
    )


@query(
    "f28_flag_to_int",
    f"WITH {SILVER_SQL} SELECT event_id, CAST(is_sold_out AS INT) AS sold_out FROM fact",
)
def flag_to_int(spark, folder):
    number = flags.flag_to_int(flags.parse_flag("is_sold_out"))
    return silver_rows(spark, folder).select("event_id", number.alias("sold_out"))


@query(
    "f29_short_id",
    "SELECT o_orderkey, 'run_' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderstatus)), 1, 8) "
    "AS run_id FROM orders",
)
def short_id(spark, folder):
    key = text.short_id("run_", "o_orderkey", "o_orderstatus")
    return table(spark, folder, "orders").select("o_orderkey", key.alias("run_id"))


ALERT_ARGUMENTS = (
    "store_id, product_id, CAST(event_date AS VARCHAR), predicted_stockout_proba, predicted_stockout_flag"
)


@query(
    "f30_alert_text",
    f"WITH {PREDICTIONS_SQL} SELECT store_id, product_id, event_date, "
    f"printf('{text.ALERT_TEXT}', 'high risk', {ALERT_ARGUMENTS}) AS message FROM predictions",
)
def alert_text(spark, folder):
    message = text.alert_text(F.lit("high risk"))
    return prediction_rows(spark, folder).select(
        "store_id", "product_id", "event_date", message.alias("message")
    )


@query(
    "f31_summary_request",
    f"WITH {PREDICTIONS_SQL} SELECT store_id, product_id, event_date, "
    f"printf('{text.SUMMARY_REQUEST}', {ALERT_ARGUMENTS}) AS request FROM predictions",
)
def summary_request(spark, folder):
    return prediction_rows(spark, folder).select(
        "store_id", "product_id", "event_date", text.summary_request().alias("request")
    )
