"""Joins, unions, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import label_window
from ..operators.joins import (
    assign_by_position,
    delete_matching,
    left_join,
    lookup_join,
    not_in,
    repeat_per_day,
    store_grid,
)
from ..operators.series import horizon_frame, with_windows
from ..plans.silver import SILVER_COLUMNS, clean_fulfillment, clean_prices, clean_search, clean_stores, clean_trends, silver
from ..schemas import EVENT_KEY, GOLD_KEY, SERIES_KEY
from .registry import query, table
from .standins import (
    GOLD_SQL,
    LOG_SQL,
    PREDICTIONS_SQL,
    alert_log_rows,
    gold_rows,
    load_ts,
    prediction_rows,
    rounded,
)

# --- the star join's inputs ---------------------------------------------------------------------------


def fulfillment_lines(spark, folder):
    day = F.col("l_shipdate").cast("date")
    odd = F.col("l_linenumber") % 2
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").cast("string").alias("product_tcin"),
        day.cast("string").alias("record_date"),
        F.date_add(day, odd + 1).cast("timestamp_ntz").alias("min_delivery_date"),
        F.date_add(day, odd + 2).cast("timestamp_ntz").alias("max_delivery_date"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(day.cast("string")).alias("cutoff_time"),
        F.concat(F.lit("METHOD "), "l_returnflag").alias("shipping_method_short_description"),
        F.when(odd == 1, "true").otherwise("no").alias("is_two_day_shipping"),
        F.lit("1").alias("is_base_shipping_method"),
        F.when(F.col("l_linenumber") == 3, None).otherwise("false").alias("is_out_of_stock_in_all_stores"),
        F.when(F.col("l_linestatus") == "F", "yes").otherwise("").alias("is_sold_out"),
        F.col("l_linestatus").alias("shipping_availability_status"),
        F.col("l_quantity").alias("available_to_promise_qty"),
        F.col("l_returnflag").alias("scheduled_delivery_status"),
        F.col("l_linenumber").cast("string").alias("scheduled_delivery_promise_qty"),
        F.col("l_tax").alias("charge_scheduled_delivery"),
        F.col("l_discount").alias("charge_one_day"),
    )


def search_lines(spark, folder):
    """A load per pair and year: several loads of a pair repeat its facts, as in the real table."""
    loads = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("p_partkey"),
        F.trunc("l_shipdate", "year").cast("string").alias("load_date"),
    )
    return (
        loads.distinct()
        .join(table(spark, folder, "part"), "p_partkey")
        .select(
            "store_id",
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("title"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_size") / 2).alias("rating"),
            F.col("p_size").cast("long").alias("reviews"),
            (F.col("p_size") % 2).cast("long").alias("availability"),
            F.col("p_type").alias("category"),
            "load_date",
        )
    )


def store_lines(spark, folder):
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    suppliers = table(spark, folder, "supplier")
    return (
        suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").cast("string").alias("store_id"),
            F.concat(F.lit(" "), "s_name").alias("location_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("postal_code"),
        )
    )


def trend_lines(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").alias("dt"))
        .agg(F.count(F.lit(1)).alias("interest_score"))
    )


def price_lines(spark, folder):
    """Prices of open lines only, so that some facts find none."""
    return (
        table(spark, folder, "lineitem")
        .filter(F.col("l_linestatus") == "O")
        .groupBy(
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_shipdate").alias("record_date"),
        )
        .agg(
            F.lit(True).alias("is_current_price_range"),
            F.lit("reg").alias("formatted_current_price_type"),
            F.lit("was").alias("formatted_comparison_price_type"),
            F.min("l_extendedprice").alias("current_retail_min"),
            F.max("l_extendedprice").alias("current_retail_max"),
            F.min("l_quantity").alias("reg_retail_min"),
            F.max("l_quantity").alias("reg_retail_max"),
            F.max("l_linenumber").cast("long").alias("cart_add_on_threshold"),
            F.min("l_returnflag").alias("formatted_current_price"),
            F.max("l_returnflag").alias("formatted_comparison_price"),
        )
    )


STAR_SQL = """
f AS (
  SELECT CAST(l_suppkey AS INT) AS store_id, CAST(l_partkey AS INT) AS product_id,
    CAST(l_shipdate AS DATE) AS record_date,
    CAST(l_shipdate AS DATE) + (l_linenumber % 2 + 1) AS min_delivery_date,
    CAST(l_shipdate AS DATE) + (l_linenumber % 2 + 2) AS max_delivery_date,
    CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS cutoff_time,
    'method ' || lower(l_returnflag) AS shipping_method,
    CASE WHEN l_linenumber % 2 = 1 THEN 'true' ELSE 'no' END AS is_two_day_shipping,
    '1' AS is_base_shipping_method,
    CASE WHEN l_linenumber <> 3 THEN 'false' END AS is_out_of_stock_in_all_stores,
    CASE WHEN l_linestatus = 'F' THEN 'yes' ELSE '' END AS is_sold_out,
    l_linestatus AS shipping_availability_status, l_quantity AS available_to_promise_qty,
    l_returnflag AS scheduled_delivery_status,
    CAST(l_linenumber AS VARCHAR) AS scheduled_delivery_promise_qty,
    l_tax AS charge_scheduled_delivery, l_discount AS charge_one_day
  FROM lineitem
),
ps AS (
  SELECT CAST(store_id AS INT) AS store_id, CAST(p_partkey AS INT) AS product_id, p_name AS title,
    p_brand AS brand, p_retailprice AS price, CAST(round_even(p_size / 2.0::DOUBLE, 0) AS INT) AS rating,
    p_size AS number_of_reviews, CAST(p_size % 2 AS VARCHAR) AS availability, p_type AS category, load_date
  FROM (SELECT DISTINCT l_suppkey AS store_id, l_partkey AS p_partkey,
          CAST(date_trunc('year', l_shipdate) AS DATE) AS load_date FROM lineitem) l
  JOIN part USING (p_partkey)
),
s AS (
  SELECT CAST(s_suppkey AS INT) AS store_id, s_name AS location_name, n_name AS city, r_name AS state,
    lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS postal_code
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
),
g AS (
  SELECT CAST(o_orderdate AS DATE) AS record_date, CAST(count(*) AS INT) AS google_trend_score
  FROM orders GROUP BY o_orderdate
),
pp AS (
  SELECT CAST(l_suppkey AS INT) AS store_id, CAST(l_partkey AS INT) AS product_id,
    CAST(l_shipdate AS DATE) AS record_date, TRUE AS is_current_price_range,
    'reg' AS formatted_current_price_type, 'was' AS formatted_comparison_price_type,
    min(l_extendedprice) AS current_retail_min, max(l_extendedprice) AS current_retail_max,
    min(l_quantity) AS reg_retail_min, max(l_quantity) AS reg_retail_max,
    CAST(max(l_linenumber) AS BIGINT) AS cart_add_on_threshold, min(l_returnflag) AS formatted_current_price,
    max(l_returnflag) AS formatted_comparison_price
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_suppkey, l_partkey, l_shipdate
)"""

STAR_COLUMNS = [c for c in SILVER_COLUMNS if c != "silver_load_ts"]
FACT = ["store_id", "product_id", "record_date", "available_to_promise_qty", "scheduled_delivery_promise_qty"]
FACT_SQL = ", ".join(f"f.{c}" for c in FACT)


def facts(spark, folder):
    return clean_fulfillment(fulfillment_lines(spark, folder)).select(*FACT)


@query(
    "j1_left_join_two_keys",
    f"WITH {STAR_SQL} SELECT {FACT_SQL}, ps.title, ps.rating, ps.price, ps.availability FROM f "
    "LEFT JOIN ps ON f.store_id = ps.store_id AND f.product_id = ps.product_id",
)
def left_join_two_keys(spark, folder):
    products = clean_search(search_lines(spark, folder)).select(
        *SERIES_KEY, "title", "rating", "price", "availability"
    )
    return left_join(facts(spark, folder), products, SERIES_KEY)


@query(
    "j2_left_join_store",
    f"WITH {STAR_SQL} SELECT {FACT_SQL}, s.location_name, s.city, s.state, s.postal_code FROM f "
    "LEFT JOIN s ON f.store_id = s.store_id",
)
def left_join_store(spark, folder):
    return lookup_join(facts(spark, folder), clean_stores(store_lines(spark, folder)), ["store_id"])


@query(
    "j3_left_join_day",
    f"WITH {STAR_SQL} SELECT {FACT_SQL}, g.google_trend_score FROM f "
    "LEFT JOIN g ON f.record_date = g.record_date",
)
def left_join_day(spark, folder):
    return lookup_join(facts(spark, folder), clean_trends(trend_lines(spark, folder)), ["record_date"])


@query(
    "j4_left_join_three_keys",
    f"WITH {STAR_SQL} SELECT {FACT_SQL}, pp.current_retail_min, pp.current_retail_max, "
    "pp.cart_add_on_threshold FROM f LEFT JOIN pp ON f.store_id = pp.store_id "
    "AND f.product_id = pp.product_id AND f.record_date = pp.record_date",
)
def left_join_three_keys(spark, folder):
    keys = ["store_id", "product_id", "record_date"]
    prices = clean_prices(price_lines(spark, folder)).select(
        *keys, "current_retail_min", "current_retail_max", "cart_add_on_threshold"
    )
    return left_join(facts(spark, folder), prices, keys)


def star(spark, folder, **options):
    return silver(
        fulfillment_lines(spark, folder),
        search_lines(spark, folder),
        store_lines(spark, folder),
        trend_lines(spark, folder),
        price_lines(spark, folder),
        load_ts(),
        **options,
    ).select(*STAR_COLUMNS)


def star_sql(products: str = "ps") -> str:
    return (
        f"SELECT {', '.join(STAR_COLUMNS)} FROM f LEFT JOIN {products} USING (store_id, product_id) "
        "LEFT JOIN s USING (store_id) LEFT JOIN g USING (record_date) "
        "LEFT JOIN pp USING (store_id, product_id, record_date)"
    )


@query("j5_silver_star_join", f"WITH {STAR_SQL} {star_sql()}")
def silver_star_join(spark, folder):
    return star(spark, folder)


@query(
    "j5_silver_latest_product",
    f"WITH {STAR_SQL}, newest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER "
    "(PARTITION BY store_id, product_id ORDER BY load_date DESC) AS n FROM ps) x WHERE n = 1) "
    + star_sql("newest"),
)
def silver_latest_product(spark, folder):
    return star(spark, folder, latest_product_only=True)


@query(
    "j5_silver_incremental",
    f"WITH {STAR_SQL} {star_sql()} WHERE record_date > (SELECT max(record_date) FROM g)",
)
def silver_incremental(spark, folder):
    after = clean_trends(trend_lines(spark, folder)).agg(F.max("record_date")).first()[0]
    return star(spark, folder, after=after)


@query(
    "j6_range_self_join",
    f"WITH {GOLD_SQL} SELECT store_id, product_id, ds, min_qty, CASE WHEN later_rows > 0 THEN any_oos END "
    "AS any_oos, later_rows FROM ahead",
)
def range_self_join(spark, folder):
    """The join over the next seven days, as a range frame: one pass, no pairs."""
    rows = gold_rows(spark, folder).select(*GOLD_KEY, "available_to_promise_qty", "is_oos_today")

    def ahead(series):
        horizon = horizon_frame(series)
        return {
            "min_qty": F.min("available_to_promise_qty").over(horizon),
            "any_oos": F.max(F.when(F.col("is_oos_today"), 1).otherwise(0)).over(horizon),
            "later_rows": F.count(F.lit(1)).over(horizon),
        }

    return with_windows(rows, SERIES_KEY, "ds", ahead).select(*GOLD_KEY, "min_qty", "any_oos", "later_rows")


@query(
    "j7_join_back_aggregate",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, min_qty, any_oos FROM lineitem "
    "LEFT JOIN (SELECT l_suppkey, l_partkey, min(l_quantity) AS min_qty, "
    "max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS any_oos FROM lineitem "
    "GROUP BY l_suppkey, l_partkey) a USING (l_suppkey, l_partkey)",
)
def join_back_aggregate(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_linestatus"
    )
    marked = rows.withColumn("oos", F.col("l_linestatus") == "F")
    grouped = label_window(marked, ["l_suppkey", "l_partkey"], "l_quantity", "oos")
    return left_join(rows.drop("l_linestatus"), grouped, ["l_suppkey", "l_partkey"])


@query(
    "j8_anti_join",
    f"WITH {PREDICTIONS_SQL}{LOG_SQL} SELECT p.store_id, p.product_id, p.event_date, "
    "p.predicted_stockout_flag FROM predictions p LEFT JOIN alert_log l "
    "ON p.store_id = l.store_id AND p.product_id = l.product_id AND p.event_date = l.event_date "
    "WHERE l.store_id IS NULL",
)
def anti_join(spark, folder):
    rows = prediction_rows(spark, folder).select(*EVENT_KEY, "predicted_stockout_flag")
    return not_in(rows, alert_log_rows(spark, folder), EVENT_KEY)


@query(
    "j9_store_grid",
    "SELECT CAST(n_nationkey AS BIGINT) AS store_id, p_partkey AS product_id, p_retailprice AS price "
    "FROM nation, part",
)
def grid_of_store_table(spark, folder):
    """25 nations, a fixed number, stand for the store list; each part goes to each of them."""
    stores = table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("store_id"))
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price")
    )
    return store_grid(products, stores)


@query(
    "j9_store_grid_listed",
    "SELECT store_id, p_partkey AS product_id FROM part, (VALUES (2), (3), (5)) stores(store_id)",
)
def grid_of_store_list(spark, folder):
    products = table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"))
    return store_grid(products, [2, 3, 5])


@query(
    "j10_left_merge",
    "SELECT l_orderkey, l_linenumber, l_partkey AS product_id, l_quantity, p_name AS title, "
    "p_retailprice AS price FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def left_merge(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id"), "l_quantity"
    )
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
    )
    return left_join(rows, products, ["product_id"])


@query(
    "j11_repeat_per_day",
    "SELECT p_partkey, CAST(unnest(generate_series(DATE '2024-02-24', DATE '2024-03-01', "
    "INTERVAL 1 DAY)) AS DATE) AS record_date FROM part",
)
def repeated_per_day(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey")
    return repeat_per_day(rows, "2024-02-24", "2024-03-01", "record_date")


@query(
    "j12_delete_using",
    "SELECT * FROM customer WHERE c_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')",
)
def delete_using(spark, folder):
    urgent = table(spark, folder, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    )
    stage = urgent.select(F.col("o_custkey").alias("c_custkey"))
    return delete_matching(table(spark, folder, "customer"), stage, ["c_custkey"])


@query(
    "j13_scalar_subquery",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def scalar_subquery(spark, folder):
    orders = table(spark, folder, "orders")
    latest = orders.select(F.max("o_orderdate"))
    return orders.filter(F.col("o_orderdate") == latest.scalar()).select("o_orderkey", "o_custkey")


@query(
    "j14_assign_by_position",
    """WITH pairs AS (SELECT DISTINCT user_id, event_type FROM events),
numbered AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR), event_type)),
             user_id, event_type) - 1 AS pair FROM pairs)
SELECT o_orderkey, user_id, event_type FROM orders
JOIN numbered ON o_orderkey % (SELECT count(*) FROM pairs) = pair""",
)
def assigned_by_position(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey")
    pairs = table(spark, folder, "events").select("user_id", "event_type").distinct()
    return assign_by_position(rows, "o_orderkey", pairs, ["user_id", "event_type"])


@query(
    "u1_union_all",
    "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def union_all(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")
    )
    return customers.unionByName(suppliers)


@query(
    "o2_latest_first",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
)
def latest_first(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return rows.orderBy(F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()).limit(1)


@query("o3_head_preview", "SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def head_preview(spark, folder):
    return table(spark, folder, "part").orderBy("p_partkey").limit(5)
