"""Sources and sinks: each writes to a fresh folder, and the query reads it back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F, types as T

from ..operators.upserts import unique_stage, upserted
from ..plans.trends import generated_trends, landed_trends, trends
from ..schemas import ALERT_LOG
from ..session import fresh_path
from ..sources import tables
from ..sources.column_roles import detect_roles, read_roles, write_roles
from ..sources.csv_files import read_csv, read_seed_products, write_csv
from .registry import query, table
from .standins import LOG_SQL, PREDICTIONS_SQL, alert_log_rows, load_ts


def id_or(column: str, other: str) -> str:
    """The role of a column of keys or texts, by its share of distinct values."""
    return f"CASE WHEN count(DISTINCT {column}) >= 0.95 * count({column}) THEN 'id' ELSE '{other}' END"


def fresh_name(label: str) -> str:
    return f"check_{label}_{uuid.uuid4().hex[:8]}"


@query("s1_table_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def table_scan(spark, folder):
    rows = tables.read_table(spark, f"{folder}/orders.parquet")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "s2_seed_csv_scan",
    "SELECT CAST(doc_id AS VARCHAR) AS product_id, text AS title, CAST(n_chars AS DOUBLE) AS price, "
    "CAST(NULL AS DOUBLE) AS rating FROM documents WHERE text IS NOT NULL AND text <> ''",
)
def seed_csv_scan(spark, folder):
    """Long texts with quotes, commas and line breaks as titles; ratings are not numbers."""
    path = fresh_path(spark, "seed-csv")
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("product_id"),
        F.regexp_replace("text", "\n", "\\\\n").alias("title"),
        F.col("n_chars").cast("string").alias("price"),
        F.col("lang").alias("rating"),
    )
    write_csv(rows, path)
    read = read_seed_products(spark, path)
    return read.withColumn("title", F.regexp_replace("title", "\\\\n", "\n"))


@query(
    "s3_csv_write",
    "SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS label, p_retailprice FROM part",
)
def csv_written(spark, folder):
    path = fresh_path(spark, "csv")
    label = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    rows = table(spark, folder, "part").select("p_partkey", label.alias("label"), "p_retailprice")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


ROLES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {role} AS sdtype FROM orders"
    for name, role in (
        ("o_orderkey", id_or("o_orderkey", "numerical")),
        ("o_custkey", id_or("o_custkey", "numerical")),
        ("o_orderstatus", id_or("o_orderstatus", "categorical")),
        ("o_totalprice", "max('numerical')"),
        ("o_orderdate", "max('datetime')"),
        ("o_orderpriority", id_or("o_orderpriority", "categorical")),
    )
)


@query("s6_column_role_file", ROLES_SQL)
def column_role_file(spark, folder):
    path = fresh_path(spark, "roles")
    write_roles(detect_roles(table(spark, folder, "orders")), path)
    return read_roles(spark, path)


@query(
    "s7_replace_table",
    "SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey",
)
def replaced(spark, folder):
    """Written twice; the second time from the table itself."""
    base, name = fresh_path(spark, "tables"), fresh_name("replace")
    tables.replace_table(spark, name, table(spark, folder, "orders"), base)
    counted = (
        spark.table(name)
        .filter(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return tables.replace_table(spark, name, counted, base)


@query(
    "s7_overwrite_days",
    "SELECT l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS record_date, l_quantity FROM lineitem",
)
def overwritten_days(spark, folder):
    """All days with zero quantities, then each day of open lines and of closed lines again."""
    path = fresh_path(spark, "days")
    month = F.trunc("record_date", "month").alias("month")
    rows = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", F.col("l_shipdate").cast("date").alias("record_date"), "l_quantity"
    )
    monthly = rows.select("*", month)
    tables.overwrite_days(monthly.withColumn("l_quantity", F.lit(0.0)), path, "month")
    for part in (F.col("month") < "1998-01-01", F.col("month") >= "1998-01-01"):
        tables.overwrite_days(monthly.filter(part), path, "month")
    return spark.read.parquet(path).select(*rows.columns)


@query(
    "s8_append_aligned",
    "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
)
def appended(spark, folder):
    """The second frame lacks a column, has an extra one and another order."""
    base, name = fresh_path(spark, "tables"), fresh_name("append")
    first = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    second = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("extra"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    tables.append_aligned(spark, name, first, base)
    return tables.append_aligned(spark, name, second, base)


@query("s9_truncate_insert", "SELECT s_suppkey AS key, s_name AS name FROM supplier")
def refilled(spark, folder):
    base, name = fresh_path(spark, "tables"), fresh_name("refill")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType())])
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    tables.refill_table(spark, name, customers, schema, base)
    return tables.refill_table(spark, name, suppliers, schema, base)


def staged_customers(spark, folder):
    """A new balance for customers with a finished order, and suppliers as new keys; keys repeat."""
    finished = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    changed = (
        table(spark, folder, "customer")
        .join(finished, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            "c_custkey",
            "c_name",
            "c_nationkey",
            F.col("o_totalprice").alias("c_acctbal"),
            "c_mktsegment",
            F.col("o_orderkey").alias("version"),
        )
    )
    new = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"),
        F.lit(0).cast("long").alias("version"),
    )
    return changed.unionByName(new)


STAGE_SQL = """
staged AS (
  SELECT c_custkey, c_name, c_nationkey, o_totalprice AS c_acctbal, c_mktsegment, o_orderkey AS version
  FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F'
  UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'NEW', 0 FROM supplier
),
stage AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS n
    FROM staged) x WHERE n = 1
)"""


@query(
    "s10_keyed_upsert",
    f"WITH {STAGE_SQL} SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM stage) "
    "UNION ALL SELECT * EXCLUDE (version) FROM stage",
)
def keyed_upsert(spark, folder):
    """Upserted twice with the same stage: the second time changes nothing."""
    base, name = fresh_path(spark, "tables"), fresh_name("upsert")
    tables.replace_table(spark, name, table(spark, folder, "customer"), base)
    stage = staged_customers(spark, folder)
    for _ in range(2):
        tables.upsert_table(spark, name, stage, ["c_custkey"], base, ["version"])
    return spark.table(name)


@query(
    "s10_upsert_as_frame",
    f"WITH {STAGE_SQL} SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM stage) "
    "UNION ALL SELECT * EXCLUDE (version) FROM stage",
)
def upsert_as_frame(spark, folder):
    customers = table(spark, folder, "customer")
    return upserted(customers, staged_customers(spark, folder), ["c_custkey"], ["version"])


@query("s11_unique_stage", f"WITH {STAGE_SQL} SELECT * FROM stage")
def stage_rows(spark, folder):
    return unique_stage(staged_customers(spark, folder), ["c_custkey"], ["version"])


@query(
    "s12_append_log",
    f"WITH {PREDICTIONS_SQL}{LOG_SQL} SELECT store_id, product_id, event_date FROM alert_log "
    "UNION ALL SELECT store_id, product_id, event_date FROM alert_log",
)
def log_appended(spark, folder):
    base, name = fresh_path(spark, "tables"), fresh_name("log")
    batch = alert_log_rows(spark, folder)
    tables.append_log(spark, name, batch, ALERT_LOG, base)
    return tables.append_log(spark, name, batch, ALERT_LOG, base).drop("alert_sent_at")


@query("s13_persistent_view", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= 910")
def persistent_view(spark, folder):
    base, name = fresh_path(spark, "tables"), fresh_name("viewed")
    tables.replace_table(spark, name, table(spark, folder, "part"), base)
    text = f"SELECT p_partkey, p_retailprice FROM {name} WHERE p_retailprice >= 910"
    return tables.create_view(spark, f"{name}_view", text)


@query(
    "s14_frame_as_view",
    "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
)
def frame_as_view(spark, folder):
    tables.as_view(table(spark, folder, "orders"), "check_orders_view")
    return spark.sql("SELECT o_orderstatus, count(*) AS orders FROM check_orders_view GROUP BY o_orderstatus")


@query("s15_declared_table", "SELECT CAST(l_suppkey AS INT) AS store_id, CAST(l_partkey AS INT) AS product_id, "
       "CAST(l_shipdate AS DATE) AS event_date FROM lineitem")
def declared_table(spark, folder):
    base, name = fresh_path(spark, "tables"), fresh_name("declared")
    tables.ensure_table(spark, name, ALERT_LOG, base)
    tables.ensure_table(spark, name, ALERT_LOG, base)
    rows = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("event_date"),
        load_ts().alias("alert_sent_at"),
    )
    return tables.append_aligned(spark, name, rows, base).drop("alert_sent_at")


@query("s16_stored_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def stored_columns(spark, folder):
    """Rows cut to the columns the catalog has for a table."""
    base, name = fresh_path(spark, "tables"), fresh_name("listed")
    rows = table(spark, folder, "part")
    assert not tables.table_exists(spark, name)
    tables.ensure_table(spark, name, rows.select("p_partkey", "p_brand", "p_size").schema, base)
    assert tables.table_exists(spark, name)
    return rows.select(*tables.table_columns(spark, name))


@query(
    "s17_parameterised_statement",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000",
)
def parameterised(spark, folder):
    tables.as_view(table(spark, folder, "orders"), "check_orders_parameter")
    return spark.sql(
        "SELECT o_orderkey, o_orderdate FROM check_orders_parameter "
        "WHERE o_orderstatus = :status AND o_totalprice > :price",
        args={"status": "O", "price": 100000},
    )


@query(
    "s18_landed_or_generated",
    "SELECT o_orderdate AS dt, 'decor' AS keyword, 'R1' AS region, count(*) AS interest_score, "
    "FALSE AS isPartial, '2024-03-01' AS load_date, '2024-03-01T00:00:00' AS load_timestamp "
    "FROM orders GROUP BY o_orderdate",
)
def landed_or_generated(spark, folder):
    now = dt.datetime(2024, 3, 1)
    landed = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("score"), F.lit(False).alias("isPartial"))
    )
    parts = table(spark, folder, "part").select(
        F.col("p_name").alias("keyword"), F.col("p_brand").alias("region")
    )
    generated = generated_trends(parts.distinct(), now.date(), now)
    return trends(landed_trends(landed, "score", "decor", "R1", now), generated)
