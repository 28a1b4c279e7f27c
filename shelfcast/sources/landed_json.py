"""Landed JSON responses to flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casting import ColumnOrName, as_column, try_double
from ..functions.text import address_line, business_key
from ..operators.columns import flattened, normalised_names
from ..schemas import PRODUCT_FULFILLMENT, STORE_DATA, STORE_RESPONSE
from .responses import document


def parse_response(
    df: DataFrame, body: str, schema: T.StructType, lineage: Mapping[str, ColumnOrName]
) -> DataFrame:
    """JSON text to typed columns, beside lineage columns.

    A body that is no JSON object gives no row: it is among the ``responses.rejects``. A field of another
    type than declared is NULL.
    """
    parsed = df.where(document(body).isNotNull()).select(
        F.from_json(body, schema).alias("_doc"),
        *[as_column(value).alias(name) for name, value in lineage.items()],
    )
    return parsed.select("_doc.*", *lineage)


def path_or_default(document: ColumnOrName, path: str, default) -> Column:
    """A value deep in JSON text; the default where any step of the path is missing."""
    return F.coalesce(F.get_json_object(as_column(document), path), F.lit(default))


def exploded(df: DataFrame, items: str, prefix: str, keep_empty: bool = True) -> DataFrame:
    """One row per item of an array of structs, its fields as ``<prefix>_<field>``.

    Rows whose list is missing or empty stay, with NULL fields, unless ``keep_empty`` is off.
    """
    item_type = df.select(items).schema[0].dataType.elementType
    explode = F.explode_outer if keep_empty else F.explode
    rows = df.select("*", explode(F.col(items)).alias("_item"))
    fields = [F.col(f"_item.`{f}`").alias(f"{prefix}_{f}") for f in item_type.fieldNames()]
    return rows.select(*df.columns, *fields)


def fulfillment_rows(
    df: DataFrame,
    body: str,
    schema: T.StructType,
    lineage: Mapping[str, ColumnOrName],
    services: str = "data.product.fulfillment.shipping_options.services",
) -> DataFrame:
    """Fulfillment responses to flat rows: one per service, or one without any.

    Struct fields become path-named columns; the list itself stays as a column, as it was landed.
    """
    parsed = parse_response(df, body, schema, lineage)
    return normalised_names(flattened(exploded(parsed, services, "services")))


# Table columns whose landed field has another name.
LANDED_NAMES = {
    "cutoff_time": "services_cutoff",
    "is_two_day_shipping": "services_is_two_day_shipping",
    "is_base_shipping_method": "services_is_base_shipping_method",
    "product_tcin": "tcin",
    "load_ts": "load_timestamp",
}


def as_fulfillment(rows: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Flat landed rows in the columns of the fulfillment table.

    A table column takes the landed column that ``names`` gives for it, else the one of its own name,
    else the field of a service, else the shallowest landed field whose path ends in its name, else
    the one of ``LANDED_NAMES``; without any it is NULL.
    """
    present = list(rows.columns)

    def source(name: str) -> str | None:
        ends = [c for c in present if c.endswith(f"_{name}") and c != f"services_{name}"]
        tried = [(names or {}).get(name), name, f"services_{name}", *sorted(ends, key=lambda c: (c.count("_"), c))]
        return next((c for c in [*tried, LANDED_NAMES.get(name)] if c in present), None)

    chosen = {f.name: source(f.name) for f in PRODUCT_FULFILLMENT.fields}
    return rows.select(
        *[
            (F.col(f"`{chosen[f.name]}`") if chosen[f.name] else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PRODUCT_FULFILLMENT.fields
        ]
    )


def store_rows(df: DataFrame, body: str, ingested_at: Column) -> DataFrame:
    """Store-locator responses to ``store_data`` rows; responses without stores, or broken ones, give none."""
    stores = (
        df.where(document(body).isNotNull())
        .select(F.from_json(body, STORE_RESPONSE).alias("doc"))
        .select(F.explode("doc.data.nearby_stores.stores").alias("s"))
        .select(
            F.col("s.store_id").alias("store_id"),
            F.col("s.location_name").alias("location_name"),
            *[
                F.coalesce(F.col(f"s.mailing_address.{source}"), F.lit("")).alias(name)
                for name, source in (
                    ("address_line1", "address_line1"),
                    ("city", "city"),
                    ("state", "region"),
                    ("postal_code", "postal_code"),
                )
            ],
            try_double("s.distance").alias("distance"),
            F.col("s.main_voice_phone_number").alias("phone"),
        )
        .withColumn("address", address_line(["address_line1", "city", "state", "postal_code"]))
        .withColumn("business_key", business_key("store_id", "address"))
        .withColumn("ingested_at", ingested_at.cast("timestamp"))
    )
    return stores.select(*STORE_DATA.fieldNames())


def to_json_text(columns: Sequence[ColumnOrName]) -> Column:
    return F.to_json(F.struct(*[as_column(c) for c in columns]))
