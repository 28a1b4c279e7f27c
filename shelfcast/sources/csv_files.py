"""CSV in and out, with quotes doubled inside quoted fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.casting import try_double
from ..schemas import SEED_PRODUCTS


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Typed by ``schema``, never inferred. ``multi_line`` allows line breaks inside quotes."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_seed_products(spark: SparkSession, path: str) -> DataFrame:
    """Products with text ids and numbers coerced; rows without id or title are dropped."""
    raw = read_csv(spark, path, SEED_PRODUCTS)
    return raw.withColumns({c: try_double(c) for c in ("price", "rating")}).dropna(
        subset=["product_id", "title"]
    )
