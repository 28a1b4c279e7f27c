"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _own_bytes(name: str, kind: T.DataType) -> Column | None:
    """Bytes of one value beyond its 16: texts and binaries as they are, nested values as JSON text."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.octet_length(F.to_json(F.struct(column.alias("v"))))
    return None


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame from one aggregate: 16 bytes for every value, and what texts, binaries and nested
    values hold (numbers in them count by their digits)."""
    own = [x for f in df.schema.fields if (x := _own_bytes(f.name, f.dataType)) is not None]
    held = sum((F.coalesce(x, F.lit(0)).cast("long") for x in own), F.lit(0))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(held.cast("long")), F.lit(0)).alias("b")
    ).first()
    return row["b"] + row["n"] * 16 * len(df.columns)


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast after measuring it (runs one aggregate over ``df``).

    A larger side is returned unmarked: the join then shuffles, and AQE splits its skewed partitions.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df
