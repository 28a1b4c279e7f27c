"""Column roles: what each column is to a generator (id, categorical, numerical, datetime, boolean)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import COLUMN_ROLES

ID_SHARE = 0.95
DISTINCT_ERROR = 0.01


def fixed_role(
    field: T.StructField,
    datetime_columns: Sequence[str] = (),
    boolean_prefixes: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
) -> tuple[str, bool]:
    """The role of a column by overrides and type, and whether its values may make it an id."""
    if field.name in categorical_columns:
        return "categorical", False
    if any(field.name.startswith(p) for p in boolean_prefixes):
        return "boolean", False
    if field.name in datetime_columns:
        return "datetime", False
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime", False
    if isinstance(field.dataType, T.BooleanType):
        return "boolean", False
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "numerical", False
    if isinstance(field.dataType, T.StringType):
        return "categorical", True
    if isinstance(field.dataType, T.IntegralType):
        return "numerical", True
    return "unknown", False


def detect_roles(
    df: DataFrame,
    datetime_columns: Sequence[str] = (),
    boolean_prefixes: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
) -> DataFrame:
    """A role per column, from its type and its share of distinct values; overrides win.

    One pass; distinct values are counted by sketch, whose error is a fifth of the share that an id
    column may fall short of all-distinct.
    Later overrides win over earlier ones.
    """

    def role(field: T.StructField) -> Column:
        fixed, may_be_id = fixed_role(field, datetime_columns, boolean_prefixes, categorical_columns)
        if not may_be_id:
            return F.lit(fixed)
        column = F.col(f"`{field.name}`")
        distinct = F.approx_count_distinct(column, DISTINCT_ERROR)
        known = F.count(column)
        return F.when((known > 0) & (distinct >= known * ID_SHARE), "id").otherwise(fixed)

    entries = [
        F.struct(F.lit(f.name).alias("column_name"), role(f).alias("sdtype")) for f in df.schema.fields
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def write_roles(roles: DataFrame, path: str) -> None:
    roles.write.json(path)


def read_roles(spark: SparkSession, path: str) -> DataFrame:
    """Roles from either form: one object a line, or one document with a map of columns."""
    document = "columns map<string, struct<sdtype: string>>, column_name string, sdtype string"
    lines = spark.read.schema(COLUMN_ROLES).json(path).filter("column_name IS NOT NULL")
    nested = spark.read.schema(document).option("multiLine", True).json(path).filter("columns IS NOT NULL")
    columns = nested.select(F.explode("columns").alias("column_name", "role"))
    return lines.unionByName(columns.select("column_name", F.col("role.sdtype").alias("sdtype")))


def write_role_document(roles: DataFrame, path: str) -> None:
    """All roles in one document: ``{"columns": {name: {"sdtype": role}}}``."""
    entry = F.struct("column_name", F.struct("sdtype"))
    columns = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    roles.agg(columns.alias("columns")).coalesce(1).write.json(path)


def marginal_kinds(roles: DataFrame, df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """(numeric, categorical, datetime) columns of ``df`` for a copula, by their roles.

    Ids are assigned by position and unknown columns left out; a numerical role needs a number.
    """
    kinds: dict[str, list[str]] = {"numerical": [], "categorical": [], "datetime": []}
    role_of = {r["column_name"]: r["sdtype"] for r in roles.collect()}  # a row a column
    for field in df.schema.fields:
        role = role_of.get(field.name)
        if role == "boolean" or (role == "numerical" and not isinstance(field.dataType, T.NumericType)):
            role = "categorical"
        if role in kinds:
            kinds[role].append(field.name)
    return kinds["numerical"], kinds["categorical"], kinds["datetime"]
