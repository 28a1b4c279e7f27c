"""The newest row of each key, kept up to date by file stream instead of ranked over all history.

A triggered batch job: it takes what has landed since its last run and stops. The table itself is the state, so a
run reads new files and the kept rows, never old files, and no task holds keys in memory; partial aggregation on the
map side sends one row a key and task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.columns import align_to
from ..operators.filters import all_known
from ..sources import tables


def _descending(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DateType):
        return -F.unix_date(column)
    if isinstance(field.dataType, T.TimestampType):
        return -F.unix_micros(column)
    if isinstance(field.dataType, T.IntegralType):
        return -column.cast("decimal(20,0)")
    raise ValueError(f"{field.name!r} must be a date, a timestamp or an integer")


def newest_of_each(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row of each key as one aggregate, which merges with earlier ones; same rows as ``latest_per_key``.

    Nulls come last; all remaining columns break ties, smallest first.
    """
    fields = {f.name: f for f in rows.schema.fields}
    rest = [c for c in rows.columns if c not in keys and c not in newest_first]
    order = [F.struct(F.col(f"`{c}`").isNull(), _descending(fields[c])) for c in newest_first]
    order += [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in rest]
    row = F.struct(*[F.col(f"`{c}`") for c in [*newest_first, *rest]])
    best = F.min(F.struct(F.struct(*order).alias("rank"), row.alias("row"))).alias("best")
    shown = [F.col(f"`{c}`") if c in keys else F.col(f"best.row.`{c}`").alias(c) for c in rows.columns]
    return rows.groupBy(*keys).agg(best).select(*shown)


def take_newest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    keys: Sequence[str],
    newest_first: Sequence[str],
    name: str,
    base: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
) -> DataFrame | None:
    """Fold newly landed Parquet files into the table ``name`` of newest rows; None while there is no row.

    ``prepare`` cleans the rows first (row by row; no joins or aggregates). Rows without a key are left out.
    A batch is ranked once, together with the kept rows, and writes the same rows when it is repeated. Rows that
    land late don't replace newer ones, whatever order the files come in.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(landing)
    rows = (prepare(rows) if prepare else rows).filter(all_known(*keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if tables.table_exists(session, name, base):
            tables.recover_table(session, name, base)
            kept = session.table(name)
            batch = kept.unionByName(align_to(batch, kept.schema))
        elif batch.isEmpty():
            return
        tables.replace_table(session, name, newest_of_each(batch, keys, newest_first), base)

    (
        rows.writeStream
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.table(name) if tables.recover_table(spark, name, base) else None
