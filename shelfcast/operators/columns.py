"""Projections: fixed column lists, constants, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def rename_and_order(df: DataFrame, renames: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames)).select(*order)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def normalised_names(df: DataFrame) -> DataFrame:
    """Lower-case names with '_' for '.'."""
    return df.toDF(*[name.lower().replace(".", "_") for name in df.columns])


def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    skipped = set(excluded)
    return [name for name in df.columns if name not in skipped]


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types: missing ones NULL, extra ones dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def fill_by_type(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs (and NaN) to '' in text columns, 0 in numeric ones, FALSE in boolean ones."""
    chosen = set(columns if columns is not None else df.columns)

    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name not in chosen:
            return column
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(column, F.lit("")).alias(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return F.coalesce(column, F.lit(False)).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.coalesce(F.when(~F.isnan(column), column), F.lit(0)).cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(column, F.lit(0)).cast(field.dataType).alias(field.name)
        return column

    return df.select(*[filled(f) for f in df.schema.fields])


def flattened(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs to flat columns named by their path; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))
