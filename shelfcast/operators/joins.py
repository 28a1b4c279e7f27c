"""Joins the jobs share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .bounds import broadcast_if_small
from .indexing import dense_index

GRID_CHUNKS = 64
HOT_ROWS = 1_000_000


def left_join(fact: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi join of two large frames: a shuffle, whose skewed partitions AQE splits on the fact side.

    AQE can do so where each side is shuffled for this join. A side that already lies by the key
    (the result of a group-by or a window over it) is not; use ``salted_left_join`` there.
    """
    return fact.join(side, list(keys), "left")


def hot_keys(fact: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more rows than a task's fair share, and into how many parts to cut each.

    There are fewer of them than shuffle partitions, by the definition of the share. One aggregate
    gives the total and the keys with more than ``hot_rows`` rows, of which there are at most
    total / hot_rows.
    """
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = F.when(F.col("_n") > hot_rows, F.struct(*keys, "_n"))
    row = counted.agg(F.sum("_n").alias("total"), F.collect_list(large).alias("large"))
    share = F.greatest(F.col("total") / partitions, F.lit(float(hot_rows)))
    found = row.select(share.alias("_share"), F.explode("large").alias("_key")).select("_share", "_key.*")
    hot = found.filter(F.col("_n") > F.col("_share"))
    return hot.select(*keys, F.ceil(F.col("_n") / F.col("_share")).cast("int").alias("_parts"))


def salted_left_join(
    fact: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left equi join where one key may hold much of the fact rows.

    The rows of a hot key are dealt into parts of a task's share each, and the key's side rows are
    repeated for every part; all other keys join as they are. ``counted`` is a cheaper frame with the
    fact's keys to count. Without hot keys this is the plain join. Runs one aggregate over the keys.
    """
    keys = list(keys)
    found = hot_keys((fact if counted is None else counted).select(*keys), keys, hot_rows)
    rows = found.collect()  # fewer rows than shuffle partitions
    if not rows:
        return fact.join(side, keys, "left")
    hot = F.broadcast(fact.sparkSession.createDataFrame(rows, found.schema))
    # The task and the row's content decide the part, so a retried task deals its rows alike, and
    # equal rows of different tasks go apart.
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *fact.columns), F.col("_parts")).cast("int")
    facts = fact.join(hot, keys, "left").withColumn("_part", F.coalesce(dealt, F.lit(0)))
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    sides = side.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
    return facts.drop("_parts").join(sides.drop("_parts"), [*keys, "_part"], "left").drop("_part")


def lookup_join(fact: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi join to a dimension, broadcast if it is measured to be small."""
    return fact.join(broadcast_if_small(side), list(keys), "left")


def not_in(rows: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``seen`` (a NULL key matches nothing, so it is kept).

    Only the distinct keys of ``seen`` are shuffled.
    """
    return rows.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def delete_matching(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    return not_in(target, stage, keys)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all shuffle partitions, for a small frame that is about to be multiplied.

    A seed table is often one file, so without this one task would make all of the generated rows.
    Rows are moved before they are multiplied; a set number keeps AQE from merging them again.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def store_grid(
    products: DataFrame, stores: DataFrame | Sequence[int], chunks: int | None = None
) -> DataFrame:
    """Every store's copy of every product row: the assortment grid.

    A store list (a parameter of a few values) is exploded next to each product, with no join. A
    store table is split into chunks by store, each product row is repeated once per chunk, and the
    two meet by an equi join on the chunk; small store tables are broadcast after a size check. There
    are as many chunks as shuffle partitions, and ``GRID_CHUNKS`` at least.
    """
    if chunks is None:
        chunks = max(GRID_CHUNKS, int(products.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not isinstance(stores, DataFrame):
        listed = F.array(*[F.lit(s) for s in stores])
        return spread(products).select(F.explode(listed).alias("store_id"), *products.columns)
    chunked = stores.withColumn("_chunk", F.pmod(F.xxhash64("store_id"), F.lit(chunks)).cast("int"))
    repeated = spread(products).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return repeated.join(broadcast_if_small(chunked), "_chunk").select(
        *stores.columns, *products.columns
    )


def repeat_per_day(df: DataFrame, first, last, day: str) -> DataFrame:
    """A copy of every row for each day from first to last, both columns or literals."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return df.withColumn(day, F.explode(days))


def assign_by_position(rows: DataFrame, row_id: str, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give row i the key pair number i mod n: pairs are tiled evenly over the rows.

    ``pairs`` must be distinct. Runs one count; the join is on a dense number, so it cannot be skewed
    by the pairs.
    """
    n_pairs = pairs.count()
    numbered = dense_index(pairs.select(*keys), keys, "_pair", rows=n_pairs)
    if n_pairs == 0:
        raise ValueError("no key pairs to assign")
    return (
        rows.withColumn("_pair", F.col(row_id) % F.lit(n_pairs))
        .join(numbered, "_pair")
        .drop("_pair")
    )


def choose_observed(rows: DataFrame, draw: str, values: DataFrame, column: str) -> DataFrame:
    """Turn a uniform draw into one of the distinct known values of ``values.column``, equally likely."""
    known = values.select(column).filter(F.col(column).isNotNull()).distinct()
    n_values = known.count()
    if n_values == 0:
        return rows.withColumn(column, F.lit(None).cast(known.schema[0].dataType))
    numbered = dense_index(known, [column], "_choice", rows=n_values)
    return (
        rows.withColumn("_choice", F.floor(F.col(draw) * n_values))
        .join(broadcast_if_small(numbered), "_choice", "left")
        .drop("_choice")
    )
