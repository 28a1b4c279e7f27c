"""Column roles from distinct-value sketches kept for each load, so that old loads aren't read again.

Every column of keys or texts keeps a HyperLogLog sketch and a count of known values; both merge, so the roles
of any set of loads are those of their rows, within the sketches' error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from .column_roles import ID_SHARE, fixed_role

#: 2^14 registers: about 0.8 % of error, some 16 KB a column and load.
SKETCH_BITS = 14


def load_distincts(
    df: DataFrame, load: str, columns: Sequence[str] | None = None, bits: int = SKETCH_BITS
) -> DataFrame:
    """load, column_name, known, sketch: a row a load and column of keys or texts, from one pass.

    ``load`` names the column that tells loads apart. Partial sketches are shuffled, not rows.
    """
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.IntegralType)) and (columns is None or f.name in columns)
    ]
    cells = []
    aggregates = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        wide = value if isinstance(df.schema[name].dataType, T.StringType) else value.cast("long")
        aggregates += [F.hll_sketch_agg(wide, F.lit(bits)).alias(f"s{i}"), F.count(value).alias(f"n{i}")]
        cells.append(F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("known"), F.col(f"s{i}").alias("sketch")))
    by = F.col(f"`{load}`").cast("string").alias("load")
    if not names:
        return df.limit(0).select(by, F.lit("").alias("column_name"), F.lit(0).cast("long").alias("known"), F.lit(b"").alias("sketch"))
    return df.groupBy(by).agg(*aggregates).select("load", F.inline(F.array(*cells)))


def merged_distincts(sketches: DataFrame) -> DataFrame:
    """column_name, known and the estimated number of distinct values over all loads given."""
    return sketches.groupBy("column_name").agg(
        F.sum("known").alias("known"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )


def merged_roles(
    schema: T.StructType,
    sketches: DataFrame,
    datetime_columns: Sequence[str] = (),
    boolean_prefixes: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
) -> DataFrame:
    """A role per column of ``schema``, as ``detect_roles`` gives it over the rows of all loads.

    A column of keys or texts without a known value is no id.
    """
    fixed = [
        (i, f.name, *fixed_role(f, datetime_columns, boolean_prefixes, categorical_columns))
        for i, f in enumerate(schema.fields)
    ]
    spark = sketches.sparkSession
    # A row a column on both sides.
    columns = spark.createDataFrame(fixed, "position int, column_name string, role string, may_be_id boolean")
    found = columns.join(merged_distincts(sketches), "column_name", "left")
    is_id = F.col("may_be_id") & (F.col("known") > 0) & (F.col("distinct_values") >= F.col("known") * ID_SHARE)
    return found.select("column_name", F.when(is_id, "id").otherwise(F.col("role")).alias("sdtype"))
