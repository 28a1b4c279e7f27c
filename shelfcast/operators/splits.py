"""Split by time: the share of rows on earlier days decides the side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TRAIN_SHARE = 0.70


def day_ranks(df: DataFrame, day: str) -> DataFrame:
    """One row per day: PERCENT_RANK of its rows in the order of days.

    Rows are counted per day first, so the ordered window sees only as many rows as there are days.
    """
    return ranks_of_counts(df.groupBy(day).agg(F.count(F.lit(1)).alias("_rows")), day)


def ranks_of_counts(counts: DataFrame, day: str) -> DataFrame:
    """``day_ranks`` of rows counted already: the day and ``_rows``."""
    ordered = Window.orderBy(F.col(day).asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col(day).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    earlier = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    total = F.sum("_rows").over(everything)
    return counts.select(
        F.col(day),
        F.when(total > 1, earlier / F.greatest(total - 1, F.lit(1))).otherwise(0.0).alias("day_rank"),
    )


def with_percent_rank(df: DataFrame, day: str) -> DataFrame:
    """The ranks joined back by broadcast: the calendar bounds them (3.7 million days in 10,000 years)."""
    ranks = day_ranks(df, day).withColumnRenamed(day, "_day")
    return df.join(F.broadcast(ranks), F.col(day).eqNullSafe(F.col("_day")), "left").drop("_day")


def side_of(rank: Column, train_share: float = TRAIN_SHARE) -> Column:
    return F.when(rank < train_share, "train").otherwise("test")


def with_split(df: DataFrame, day: str, train_share: float = TRAIN_SHARE) -> DataFrame:
    """Add ``split``: 'train' or 'test'; a day is never divided."""
    ranked = with_percent_rank(df, day)
    return ranked.withColumn("split", side_of(F.col("day_rank"), train_share)).drop("day_rank")
