"""Aggregates and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.flags import out_of_stock, parse_flag
from ..operators.aggregates import (
    duplicate_keys,
    feature_stats,
    label_window,
    latest_row,
    min_max,
    row_count,
    table_info,
    watermark_frame,
)
from ..operators.metrics import accuracy, f1, roc_auc
from ..session import fresh_path
from ..sources.column_roles import detect_roles
from ..sources.load_roles import load_distincts, merged_roles
from .q_sinks import id_or
from .registry import query, table
from .standins import SILVER_SQL, rounded, silver_rows


@query(
    "a1_watermark",
    "SELECT 'orders' AS source, max(CAST(o_orderdate AS DATE)) AS watermark FROM orders "
    "UNION ALL SELECT 'none', DATE '1900-01-01'",
)
def latest_day(spark, folder):
    orders = table(spark, folder, "orders")
    none = orders.filter(F.col("o_orderdate").isNull())
    parts = [
        watermark_frame(rows, "o_orderdate").select(F.lit(name).alias("source"), "watermark")
        for name, rows in (("orders", orders), ("none", none))
    ]
    return parts[0].unionByName(parts[1])


@query("a2_row_count", "SELECT count(*) AS row_count FROM lineitem")
def count_rows(spark, folder):
    return row_count(table(spark, folder, "lineitem"))


@query(
    "a3_grouped_min_max",
    f"WITH {SILVER_SQL} SELECT store_id, product_id, ds, min(available_to_promise_qty) AS min_qty, "
    "max(CASE WHEN is_sold_out OR is_out_of_stock_in_all_stores OR available_to_promise_qty <= 0 "
    "THEN 1 ELSE 0 END) AS any_oos FROM fact GROUP BY store_id, product_id, ds",
)
def grouped_min_max(spark, folder):
    rows = silver_rows(spark, folder).select(
        F.col("store_id").cast("int").alias("store_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("record_date").cast("date").alias("ds"),
        "available_to_promise_qty",
        out_of_stock(
            "available_to_promise_qty",
            parse_flag("is_sold_out"),
            parse_flag("is_out_of_stock_in_all_stores"),
        ).alias("oos"),
    )
    return label_window(rows, ["store_id", "product_id", "ds"], "available_to_promise_qty", "oos")


@query(
    "a4_key_uniqueness",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def key_uniqueness(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a5_distinct_rows", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query(
    "a6_unique_values",
    "SELECT p_brand, count(DISTINCT p_name) AS names, count(DISTINCT p_type) AS types "
    "FROM part GROUP BY p_brand",
)
def unique_values(spark, folder):
    part = table(spark, folder, "part")
    return part.groupBy("p_brand").agg(
        F.count_distinct("p_name").alias("names"), F.count_distinct("p_type").alias("types")
    )


@query(
    "a7_min_max_summary",
    "SELECT min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice, "
    "min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem",
)
def min_max_summary(spark, folder):
    return min_max(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])


@query(
    "a8_latest_record",
    "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) o WHERE n = 1",
)
def latest_record(spark, folder):
    columns = ["o_orderdate", "o_orderkey", "o_orderstatus"]
    return latest_row(table(spark, folder, "orders"), "o_orderdate", columns, ["o_custkey"])


STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a9_mean_and_deviation",
    "SELECT "
    + ", ".join(
        f"round(avg({c}), 6) AS {c}__mean, round(stddev_pop({c}), 6) AS {c}__std" for c in STATS
    )
    + " FROM lineitem",
)
def mean_and_deviation(spark, folder):
    rows = table(spark, folder, "lineitem")
    return rounded(rows.agg(*feature_stats(rows, STATS)))


# Long texts are predicted to be good ones.
LONG = 1000
SCORED_SQL = (
    f"scored AS (SELECT quality AS label, n_chars AS score, CAST(n_chars >= {LONG} AS INT) AS predicted "
    "FROM labels JOIN documents USING (doc_id))"
)


def scored(spark, folder):
    rows = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    return rows.select(
        F.col("quality").alias("label"),
        F.col("n_chars").alias("score"),
        (F.col("n_chars") >= LONG).cast("int").alias("predicted"),
    )


@query(
    "a10_accuracy",
    f"WITH {SCORED_SQL} SELECT round(avg(CAST(label = predicted AS DOUBLE)), 9) AS accuracy FROM scored",
)
def accuracy_of_rule(spark, folder):
    return rounded(scored(spark, folder).agg(accuracy("label", "predicted").alias("accuracy")), 9)


@query(
    "a11_f1",
    f"WITH {SCORED_SQL}, sums AS (SELECT sum(label * predicted) AS tp, sum(label) AS p, "
    "sum(predicted) AS q FROM scored) SELECT round(2.0 * tp / (p + q), 9) AS f1 FROM sums",
)
def f1_of_rule(spark, folder):
    return rounded(scored(spark, folder).agg(f1("label", "predicted").alias("f1")), 9)


@query(
    "a12_roc_auc",
    f"""WITH {SCORED_SQL},
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
           AS mean_rank FROM scored),
sums AS (SELECT sum(CASE WHEN label = 1 THEN mean_rank END) AS ranks,
         CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS n FROM ranked)
SELECT round((ranks - p * (p + 1) / 2) / (p * n), 9) AS roc_auc FROM sums""",
)
def auc_of_score(spark, folder):
    return rounded(roc_auc(scored(spark, folder), "label", "score"), 9)


ORDER_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]


@query(
    "a13_table_info",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f"count({name}) AS non_null, count(*) AS rows FROM orders"
        for i, (name, kind) in enumerate(ORDER_COLUMNS)
    ),
)
def info(spark, folder):
    return table_info(table(spark, folder, "orders"))


LINE_ROLES = [
    ("l_orderkey", id_or("l_orderkey", "numerical")),
    ("l_partkey", "max('categorical')"),
    ("l_suppkey", "max('categorical')"),
    ("l_linenumber", id_or("l_linenumber", "numerical")),
    ("l_quantity", "max('numerical')"),
    ("l_extendedprice", "max('numerical')"),
    ("l_discount", "max('numerical')"),
    ("l_tax", "max('numerical')"),
    ("l_returnflag", id_or("l_returnflag", "categorical")),
    ("l_linestatus", id_or("l_linestatus", "categorical")),
    ("l_shipdate", "max('datetime')"),
]


@query(
    "a14_column_roles",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {role} AS sdtype FROM lineitem" for name, role in LINE_ROLES
    ),
)
def column_roles(spark, folder):
    return detect_roles(
        table(spark, folder, "lineitem"),
        datetime_columns=["l_shipdate"],
        categorical_columns=["l_suppkey", "l_partkey"],
    )


ORDER_ROLES = [
    ("o_orderkey", id_or("o_orderkey", "numerical")),
    ("o_custkey", id_or("o_custkey", "numerical")),
    ("o_orderstatus", id_or("o_orderstatus", "categorical")),
    ("o_orderpriority", id_or("o_orderpriority", "categorical")),
    ("o_totalprice", "max('numerical')"),
]


@query(
    "a14_roles_of_merged_loads",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {role} AS sdtype FROM orders" for name, role in ORDER_ROLES
    ),
)
def roles_of_merged_loads(spark, folder):
    """Sketches kept by year of the order, merged without reading the orders again."""
    orders = table(spark, folder, "orders")
    names = [name for name, _ in ORDER_ROLES]
    path = fresh_path(spark, "distincts")
    year = F.substring(F.col("o_orderdate").cast("string"), 1, 4)
    load_distincts(orders.select(*names, year.alias("year")), "year", names).write.parquet(path)
    return merged_roles(orders.select(*names).schema, spark.read.parquet(path))
