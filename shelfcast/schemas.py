"""Table schemas. Names, types and order are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """A flat schema from 'name TYPE, ...'; needs no session, unlike a DDL string."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PRODUCT_SEARCH = _schema(
    "store_id BIGINT, product_id STRING, title STRING, price DOUBLE, rating DOUBLE, brand STRING, "
    "availability BIGINT, reviews BIGINT, url STRING, category STRING, keyword STRING, "
    "load_date STRING, load_timestamp STRING, record_date STRING"
)

PRODUCT_FULFILLMENT = _schema(
    "store_id BIGINT, tcin_product_id STRING, record_date STRING, load_date STRING, load_ts STRING, "
    "shipping_method_id STRING, shipping_method_short_description STRING, "
    "service_level_description STRING, min_delivery_date TIMESTAMP_NTZ, "
    "max_delivery_date TIMESTAMP_NTZ, cutoff_time STRING, is_base_shipping_method STRING, "
    "is_two_day_shipping STRING, product_tcin STRING, product_typename STRING, "
    "scheduled_delivery_status STRING, scheduled_delivery_promise_qty STRING, "
    "scheduled_delivery_location_id STRING, is_out_of_stock_in_all_stores STRING, "
    "product_id STRING, is_sold_out STRING, shipping_availability_status STRING, "
    "available_to_promise_qty DOUBLE, loyalty_availability_status STRING, "
    "fulfillment_product_id STRING, delivery_location STRING, notify_me_eligible STRING, "
    "notify_me_enabled STRING, charge_scheduled_delivery DOUBLE, charge_one_day DOUBLE, "
    "store_positions STRING, load_timestamp STRING, tcin STRING"
)

PRICE_DETAILS = _schema(
    "store_id BIGINT, product_id STRING, price DOUBLE, record_date TIMESTAMP_NTZ, "
    "is_current_price_range BOOLEAN, formatted_current_price_type STRING, "
    "formatted_comparison_price_type STRING, current_retail_min DOUBLE, current_retail_max DOUBLE, "
    "reg_retail_min DOUBLE, reg_retail_max DOUBLE, cart_add_on_threshold BIGINT, "
    "formatted_current_price STRING, formatted_comparison_price STRING"
)

STORE_DATA = _schema(
    "business_key STRING, store_id STRING, location_name STRING, address_line1 STRING, city STRING, "
    "state STRING, postal_code STRING, address STRING, distance DOUBLE, phone STRING, "
    "ingested_at TIMESTAMP"
)

TRENDS = _schema(
    "dt TIMESTAMP_NTZ, keyword STRING, region STRING, interest_score BIGINT, isPartial BOOLEAN, "
    "load_date STRING, load_timestamp STRING"
)

SEED_PRODUCTS = _schema("product_id STRING, title STRING, price STRING, rating STRING")

def _nested(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STORE_RESPONSE = _nested(
    data=_nested(
        nearby_stores=_nested(
            stores=T.ArrayType(
                _nested(
                    store_id=T.StringType(),
                    location_name=T.StringType(),
                    distance=T.StringType(),
                    main_voice_phone_number=T.StringType(),
                    mailing_address=_nested(
                        address_line1=T.StringType(),
                        city=T.StringType(),
                        region=T.StringType(),
                        postal_code=T.StringType(),
                    ),
                )
            )
        )
    )
)

ALERT_LOG = _schema("store_id INT, product_id INT, event_date DATE, alert_sent_at TIMESTAMP")

ALERT_OUTBOX = _schema(
    "store_id INT, product_id INT, event_date DATE, predicted_stockout_proba DOUBLE, "
    "predicted_stockout_flag INT, message STRING"
)

DATASET = _schema("dataset_id STRING, model_id STRING, created_at TIMESTAMP")

TRAINING_RUN = _schema(
    "run_id STRING, model_id STRING, dataset_id STRING, params STRING, metrics STRING, "
    "artifact STRING, status STRING"
)

MODEL_VERSION = _schema(
    "model_version_id STRING, model_id STRING, training_run_id STRING, artifact_path STRING, "
    "metrics_json STRING, status STRING"
)

MODEL_WEIGHTS = _schema(
    "model_version_id STRING, trained_at TIMESTAMP, position INT, name STRING, mean DOUBLE, "
    "deviation DOUBLE, coefficient DOUBLE, intercept DOUBLE"
)

COLUMN_ROLES = _schema("column_name STRING, sdtype STRING")

SERIES_KEY = ["store_id", "product_id"]
GOLD_KEY = ["store_id", "product_id", "ds"]
EVENT_KEY = ["store_id", "product_id", "event_date"]

# Model inputs, in the order of the feature table.
FEATURES = [
    "is_oos_today",
    "is_sold_out",
    "is_out_of_stock_in_all_stores",
    "available_to_promise_qty",
    "trend_7d_avg",
    "google_trend_score",
    "rating",
    "number_of_reviews",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "inv_7d_avg",
    "inv_7d_min",
    "inv_7d_max",
    "inv_7d_std",
    "price_change_7d",
    "rating_change_7d",
    "reviews_change_7d",
]

# Inputs of the wide training loader.
LOADER_FEATURES = [
    "available_to_promise_qty",
    "is_out_of_stock_in_all_stores",
    "is_sold_out",
    "is_two_day_shipping",
    "is_base_shipping_method",
    "price",
    "listed_price",
    "current_retail_min",
    "current_retail_max",
    "reg_retail_min",
    "reg_retail_max",
    "rating",
    "number_of_reviews",
    "google_trend_score",
    "inv_7d_avg",
    "inv_7d_min",
    "inv_7d_max",
    "inv_7d_std",
    "price_change_7d",
    "rating_change_7d",
    "reviews_change_7d",
    "trend_7d_avg",
]
