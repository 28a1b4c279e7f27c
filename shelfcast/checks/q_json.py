"""JSON and arrays.

A conversation turn plays a landed fulfillment response: each line of its text is a service, a system
turn has an empty list and a turn of one line no list at all. A supplier plays a store response.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..operators.columns import flattened
from ..sources.landed_json import (
    exploded,
    fulfillment_rows,
    parse_response,
    path_or_default,
    store_rows,
    to_json_text,
)
from ..session import fresh_path
from ..sources.responses import discovered_rows, rejects
from .registry import query, table


def _struct(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SERVICE = _struct(line=T.IntegerType(), body=T.StringType())
RESPONSE = _struct(
    data=_struct(
        product=_struct(
            fulfillment=_struct(
                is_out_of_stock=T.BooleanType(),
                shipping_options=_struct(
                    availability_status=T.StringType(), services=T.ArrayType(SERVICE)
                ),
            )
        )
    )
)
LINEAGE = ["store_id", "tcin", "record_date", "load_date", "load_timestamp"]


def lineage():
    return {
        "store_id": "conv_id",
        "tcin": F.col("turn").cast("string"),
        "record_date": F.lit("2024-03-01"),
        "load_date": F.lit("2024-03-01"),
        "load_timestamp": F.lit("2024-03-01T00:00:00"),
    }


def landed(spark, folder):
    """Response text per turn, and the turn's keys."""
    lines = F.split("text", "\n")
    listed = F.transform(
        lines, lambda body, i: F.struct((i + 1).cast("int").alias("line"), body.alias("body"))
    )
    empty = F.slice(listed, 1, 0)
    services = F.when(F.col("role") == "system", empty).when(F.size(lines) > 1, listed)
    options = F.struct(F.upper("role").alias("availability_status"), services.alias("services"))
    fulfillment = F.struct(
        (F.col("turn") == 0).alias("is_out_of_stock"), options.alias("shipping_options")
    )
    product = F.struct(fulfillment.alias("fulfillment"))
    body = F.to_json(F.struct(F.struct(product.alias("product")).alias("data")))
    return table(spark, folder, "conversations").select("conv_id", "turn", "role", "text", body.alias("body"))


TURNS_SQL = """
turns AS (
  SELECT conv_id AS store_id, CAST(turn AS VARCHAR) AS tcin, turn = 0 AS oos, upper(role) AS status, role,
    string_split(text, chr(10)) AS lines FROM conversations
),
numbered AS (
  SELECT store_id, tcin, oos, status, CAST(i AS INT) AS line, lines[i] AS body
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM turns WHERE role <> 'system' AND len(lines) > 1) x
)"""
DAYS_SQL = "'2024-03-01' AS record_date, '2024-03-01' AS load_date, '2024-03-01T00:00:00' AS load_timestamp"


@query(
    "n1_path_or_default",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, 'none' AS missing FROM events",
)
def path_with_default(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        path_or_default("props", "$.k", "none").alias("k"),
        path_or_default("props", "$.options.list", "none").alias("missing"),
    )


@query(
    "n2_explode_keep_empty",
    f"WITH {TURNS_SQL} SELECT store_id, tcin, line, body FROM numbered UNION ALL "
    "SELECT store_id, tcin, NULL, NULL FROM turns WHERE role = 'system' OR len(lines) <= 1",
)
def explode_keep_empty(spark, folder):
    parsed = parse_response(landed(spark, folder), "body", RESPONSE, lineage())
    services = parsed.select(
        "store_id", "tcin", F.col("data.product.fulfillment.shipping_options.services").alias("services")
    )
    rows = exploded(services, "services", "services")
    return rows.select(
        "store_id", "tcin", F.col("services_line").alias("line"), F.col("services_body").alias("body")
    )


@query("n3_explode_drop_empty", f"WITH {TURNS_SQL} SELECT store_id, tcin, line, body FROM numbered")
def explode_drop_empty(spark, folder):
    parsed = parse_response(landed(spark, folder), "body", RESPONSE, lineage())
    services = parsed.select(
        "store_id", "tcin", F.col("data.product.fulfillment.shipping_options.services").alias("services")
    )
    rows = exploded(services, "services", "services", keep_empty=False)
    return rows.select(
        "store_id", "tcin", F.col("services_line").alias("line"), F.col("services_body").alias("body")
    )


@query(
    "n4_prefixed_fields",
    "SELECT c_custkey, c_name AS info_name, c_acctbal AS info_balance FROM customer",
)
def prefixed_fields(spark, folder):
    info = F.array(F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
    rows = table(spark, folder, "customer").select("c_custkey", info.alias("infos"))
    return exploded(rows, "infos", "info").drop("infos")


@query(
    "n5_flatten_structs",
    f"WITH {TURNS_SQL} SELECT store_id, tcin, oos AS data_product_fulfillment_is_out_of_stock, "
    "status AS data_product_fulfillment_shipping_options_availability_status FROM turns",
)
def flatten_structs(spark, folder):
    parsed = parse_response(landed(spark, folder), "body", RESPONSE, lineage())
    flat = flattened(parsed.select("store_id", "tcin", "data"))
    return flat.drop("data_product_fulfillment_shipping_options_services")


@query(
    "n6_json_text",
    """SELECT p_partkey, '{"model":"' || p_brand || '","size":' || CAST(p_size AS VARCHAR) || '}' AS params FROM part""",
)
def json_text(spark, folder):
    params = to_json_text([F.col("p_brand").alias("model"), F.col("p_size").alias("size")])
    return table(spark, folder, "part").select("p_partkey", params.alias("params"))


@query(
    "n7_fulfillment_rows",
    f"""WITH {TURNS_SQL}, every AS (
  SELECT store_id, tcin, oos, status, line, body FROM numbered
  UNION ALL SELECT store_id, tcin, oos, status, NULL, NULL FROM turns WHERE role = 'system' OR len(lines) <= 1)
SELECT store_id, tcin, {DAYS_SQL}, oos AS data_product_fulfillment_is_out_of_stock,
  status AS data_product_fulfillment_shipping_options_availability_status,
  line AS services_line, body AS services_body FROM every""",
)
def fulfillment_job(spark, folder):
    flat = fulfillment_rows(landed(spark, folder), "body", RESPONSE, lineage())
    return flat.drop("data_product_fulfillment_shipping_options_services")


@query(
    "s4_json_response_scan",
    f"WITH {TURNS_SQL} SELECT store_id, tcin, {DAYS_SQL}, oos, status, "
    "CAST(CASE WHEN role = 'system' THEN 0 WHEN len(lines) > 1 THEN len(lines) END AS INT) AS services FROM turns",
)
def json_response_scan(spark, folder):
    """Responses landed as files of one JSON document per line, with their keys beside the body."""
    path = fresh_path(spark, "landed-responses")
    landed(spark, folder).select("conv_id", "turn", "body").write.json(path)
    schema = _struct(conv_id=T.LongType(), turn=T.LongType(), body=T.StringType())
    read = spark.read.schema(schema).json(path)
    parsed = parse_response(read, "body", RESPONSE, lineage())
    ship = "data.product.fulfillment.shipping_options"
    count = F.size(f"{ship}.services")
    return parsed.select(
        *LINEAGE,
        F.col("data.product.fulfillment.is_out_of_stock").alias("oos"),
        F.col(f"{ship}.availability_status").alias("status"),
        F.when(F.col(f"{ship}.services").isNotNull(), count).alias("services"),
    )


def store_responses(spark, folder):
    """A response per supplier; some have no id, no city or a distance that is not a number."""
    nation = table(spark, folder, "nation")
    key, nation_key = F.col("s_suppkey"), F.col("s_nationkey")
    mail = F.struct(
        F.concat(F.lit(" "), "s_name").alias("address_line1"),
        F.when(nation_key % 3 > 0, F.col("n_name")).alias("city"),
        F.when(nation_key % 2 > 0, "R1").otherwise("").alias("region"),
        F.lpad(nation_key.cast("string"), 5, "0").alias("postal_code"),
    )
    store = F.struct(
        F.when(nation_key % 5 > 0, key.cast("string")).alias("store_id"),
        F.col("s_name").alias("location_name"),
        F.when(nation_key % 4 > 0, F.col("s_acctbal").cast("string")).otherwise("far").alias("distance"),
        F.lit("555-0100").alias("main_voice_phone_number"),
        mail.alias("mailing_address"),
    )
    stores = F.when(nation_key % 7 > 0, F.array(store)).otherwise(F.slice(F.array(store), 1, 0))
    nearby = F.struct(F.struct(stores.alias("stores")).alias("nearby_stores"))
    return (
        table(spark, folder, "supplier")
        .join(nation, nation_key == F.col("n_nationkey"), "left")
        .select(F.to_json(F.struct(nearby.alias("data"))).alias("body"))
    )


STORE_ROWS_SQL = """
parts AS (
  SELECT CASE WHEN s_nationkey % 5 > 0 THEN CAST(s_suppkey AS VARCHAR) END AS store_id,
    s_name AS location_name, ' ' || s_name AS address_line1,
    CASE WHEN s_nationkey % 3 > 0 THEN n_name ELSE '' END AS city,
    CASE WHEN s_nationkey % 2 > 0 THEN 'R1' ELSE '' END AS state,
    lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS postal_code,
    CASE WHEN s_nationkey % 4 > 0 THEN s_acctbal END AS distance, '555-0100' AS phone
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey % 7 > 0
),
addressed AS (
  SELECT *, concat_ws(', ', trim(address_line1), CASE WHEN city <> '' THEN city END,
    CASE WHEN state <> '' THEN state END, postal_code) AS address FROM parts
),
store_rows AS (
  SELECT COALESCE(store_id, 'addr_' || substr(sha256(address), 1, 32)) AS business_key, * FROM addressed
)"""


@query("s5_store_locator_scan", f"WITH {STORE_ROWS_SQL} SELECT * FROM store_rows")
def store_locator_scan(spark, folder):
    rows = store_rows(store_responses(spark, folder), "body", F.lit("2024-03-01 00:00:00"))
    return rows.drop("ingested_at")


# --- bodies that are no documents ----------------------------------------------------------------------


def spoiled(spark, folder):
    """Landed responses of which some are cut off, empty, wrapped in a list, followed by text, or missing."""
    kind = (F.col("conv_id") * 31 + F.col("turn")) % 12
    body = F.col("body")
    broken = (
        F.when(kind == 0, F.substring(body, F.lit(1), F.length(body) - 3))
        .when(kind == 1, F.lit(" "))
        .when(kind == 2, F.concat(F.lit("["), body, F.lit("]")))
        .when(kind == 3, F.concat(body, F.lit(" x")))
        .when(kind > 4, body)
    )
    return landed(spark, folder).withColumn("body", broken)


@query(
    "s4_rejects",
    f"""SELECT conv_id AS store_id, CAST(turn AS VARCHAR) AS tcin, {DAYS_SQL},
  CASE (conv_id * 31 + turn) % 12 WHEN 0 THEN 'not JSON' WHEN 2 THEN 'not a JSON object' WHEN 3 THEN 'not JSON'
    ELSE 'empty body' END AS reason
FROM conversations WHERE (conv_id * 31 + turn) % 12 <= 4""",
)
def response_rejects(spark, folder):
    """Bodies that give no fact, with the reason and the load they came with."""
    return rejects(spoiled(spark, folder), "body", lineage()).drop("body")


@query(
    "n7_broken_bodies",
    f"""WITH {TURNS_SQL.replace("FROM conversations", "FROM conversations WHERE (conv_id * 31 + turn) % 12 > 4")}
SELECT store_id, tcin, {DAYS_SQL}, line AS services_line FROM numbered
UNION ALL SELECT store_id, tcin, {DAYS_SQL}, NULL FROM turns WHERE role = 'system' OR len(lines) <= 1""",
)
def facts_beside_broken_bodies(spark, folder):
    """Broken bodies leave no fact behind."""
    flat = fulfillment_rows(spoiled(spark, folder), "body", RESPONSE, lineage())
    return flat.select(*LINEAGE, "services_line")


# --- fields that nobody declared -----------------------------------------------------------------------


def undeclared(spark, folder):
    """Responses whose fields differ by role, with a field that is a number or a text."""
    turn, role = F.col("turn").cast("string"), F.col("role")
    own = F.when(role == "user", F.concat(F.lit(',"Ratio":'), turn, F.lit(".5"))).when(
        role == "assistant", F.concat(F.lit(',"Tone":{"Name":"'), F.upper(role), F.lit('"}'))
    )
    mixed = F.when(F.col("turn") % 2 == 0, turn).otherwise(F.concat(F.lit('"t'), turn, F.lit('"')))
    services = F.when(
        F.col("turn") % 3 > 0,
        F.concat(
            F.lit(',"data":{"product":{"fulfillment":{"shipping_options":{"services":[{"n":1},{"n":2,"cost":{"cents":'),
            turn,
            F.lit("}}]}}}}"),
        ),
    )
    body = F.concat(
        F.lit('{"Extra":{"Len.X":'), F.length("text").cast("string"), F.coalesce(own, F.lit("")), F.lit('},"mixed":'),
        mixed, F.coalesce(services, F.lit("")), F.lit("}"),
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", body.alias("body"))


@query(
    "n5_discovered_fields",
    """WITH c AS (SELECT *, CAST(turn AS VARCHAR) AS t, unnest(CASE WHEN turn % 3 > 0 THEN [1, 2] ELSE [0] END) AS n
  FROM conversations)
SELECT conv_id AS store_id, t AS tcin, CAST(length(text) AS BIGINT) AS extra_len_x,
  CASE WHEN role = 'user' THEN CAST(t || '.5' AS DOUBLE) END AS extra_ratio,
  CASE WHEN role = 'assistant' THEN upper(role) END AS extra_tone_name,
  CASE WHEN turn % 2 = 0 THEN t ELSE 't' || t END AS mixed,
  CAST(nullif(n, 0) AS BIGINT) AS services_n,
  CASE WHEN n = 2 THEN CAST(turn AS BIGINT) END AS services_cost_cents FROM c""",
)
def discovered_fields(spark, folder):
    rows = discovered_rows(
        undeclared(spark, folder), "body", {"store_id": "conv_id", "tcin": F.col("turn").cast("string")}
    )
    return rows.drop("data_product_fulfillment_shipping_options_services")
