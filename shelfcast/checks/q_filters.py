"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.flags import TRUE_TEXTS
from ..operators.aggregates import watermark
from ..operators.columns import (
    columns_except,
    normalised_names,
    rename_and_order,
    with_constants,
)
from ..operators.filters import all_known, equals, flagged_above, newer_than, one_of, within
from ..schemas import EVENT_KEY
from .registry import query, table
from .standins import GOLD_SQL, PREDICTIONS_SQL, SILVER_SQL, gold_rows, prediction_rows, silver_rows


@query(
    "p1_project_alias",
    "SELECT l_suppkey AS store_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS ds, "
    "l_quantity AS available_to_promise_qty FROM lineitem",
)
def project_alias(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("ds"),
        F.col("l_quantity").alias("available_to_promise_qty"),
    )


@query(
    "p2_rename_reorder",
    "SELECT o_orderdate AS dt, o_orderpriority AS keyword, o_orderstatus AS region, "
    "o_totalprice AS interest_score FROM orders",
)
def rename_reorder(spark, folder):
    renames = {
        "o_orderdate": "dt",
        "o_orderpriority": "keyword",
        "o_orderstatus": "region",
        "o_totalprice": "interest_score",
    }
    order = ["dt", "keyword", "region", "interest_score"]
    return rename_and_order(table(spark, folder, "orders"), renames, order)


@query(
    "p3_constant_columns",
    "SELECT p_partkey, 'seasonal_decor' AS keyword, '2024-03-01' AS load_date, 0 AS partial FROM part",
)
def constant_columns(spark, folder):
    constants = {"keyword": "seasonal_decor", "load_date": "2024-03-01", "partial": 0}
    return with_constants(table(spark, folder, "part").select("p_partkey"), constants)


@query(
    "p4_normalised_names",
    "SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size FROM part",
)
def normalised(spark, folder):
    columns = [
        F.col("p_partkey").alias("Part.Key"),
        F.col("p_name").alias("PART.NAME"),
        F.col("p_size").alias("Size"),
    ]
    return normalised_names(table(spark, folder, "part").select(*columns))


@query(
    "p5_columns_by_exclusion",
    "SELECT * EXCLUDE (l_orderkey, l_linenumber, l_linestatus) FROM lineitem",
)
def by_exclusion(spark, folder):
    rows = table(spark, folder, "lineitem")
    return rows.select(*columns_except(rows, ["l_orderkey", "l_linenumber", "l_linestatus"]))


@query("p6_equality_filter", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def equality_filter(spark, folder):
    return table(spark, folder, "lineitem").filter(equals("l_returnflag", "R"))


@query(
    "p7_known_filter",
    f"WITH {SILVER_SQL} SELECT event_id FROM fact "
    "WHERE is_sold_out IS NOT NULL AND is_out_of_stock_in_all_stores IS NOT NULL "
    "OR is_sold_out IS NULL AND google_trend_score % 25 = 5",
)
def known_filter(spark, folder):
    rows = silver_rows(spark, folder)
    return rows.filter(all_known("is_sold_out", "is_out_of_stock_in_all_stores")).select("event_id")


@query(
    "p8_between_iso_text",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS load_date FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' "
    "AND o_totalprice IS NOT NULL",
)
def between_iso_text(spark, folder):
    rows = table(spark, folder, "orders").withColumn(
        "load_date", F.col("o_orderdate").cast("date").cast("string")
    )
    kept = rows.filter(within("load_date", "1997-01-01", "1998-06-30", "o_totalprice"))
    return kept.select("o_orderkey", "load_date")


@query(
    "p9_in_list",
    f"WITH {SILVER_SQL} SELECT event_id FROM fact WHERE is_sold_out",
)
def in_list(spark, folder):
    rows = silver_rows(spark, folder)
    return rows.filter(one_of(F.lower("is_sold_out"), TRUE_TEXTS)).select("event_id")


@query(
    "p10_threshold_conjunction",
    f"WITH {PREDICTIONS_SQL} SELECT store_id, product_id, event_date FROM predictions "
    "WHERE predicted_stockout_flag = 1 AND predicted_stockout_proba >= 0.8",
)
def threshold_conjunction(spark, folder):
    rows = prediction_rows(spark, folder)
    condition = flagged_above("predicted_stockout_flag", "predicted_stockout_proba", 0.80)
    return rows.filter(condition).select(*EVENT_KEY)


@query(
    "p11_three_valued_or",
    f"WITH {GOLD_SQL} SELECT store_id, product_id, ds, "
    "is_sold_out OR is_out_of_stock_in_all_stores AS either FROM gold",
)
def three_valued_or(spark, folder):
    either = F.col("is_sold_out") | F.col("is_out_of_stock_in_all_stores")
    return gold_rows(spark, folder).select("store_id", "product_id", "ds", either.alias("either"))


@query(
    "p12_newer_than_watermark",
    "SELECT l_orderkey, l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS record_date FROM lineitem "
    "WHERE CAST(l_shipdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
)
def newer_than_watermark(spark, folder):
    after = watermark(table(spark, folder, "orders"), "o_orderdate")
    rows = table(spark, folder, "lineitem").withColumn("record_date", F.col("l_shipdate").cast("date"))
    return newer_than(rows, "record_date", after).select(
        "l_orderkey", "l_suppkey", "l_partkey", "record_date"
    )
