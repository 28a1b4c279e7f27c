"""Model inputs from gold rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.flags import flag_to_int
from ..operators.splits import TRAIN_SHARE, ranks_of_counts, side_of, with_split
from ..schemas import FEATURES, LOADER_FEATURES


def _feature_columns(created_at: Column | None, split: bool) -> list:
    position = FEATURES.index("reg_retail_max") + 1
    columns = [
        "store_id",
        "product_id",
        F.col("ds").alias("event_date"),
        *FEATURES[:position],
        "brand",
        "category",
        *FEATURES[position:],
        F.col("stockout_next_7d").alias("stockout_label"),
        *(["split"] if split else []),
    ]
    return columns if created_at is None else [*columns, created_at.alias("created_at")]


def feature_table(
    gold: DataFrame, created_at: Column | None = None, train_share: float = TRAIN_SHARE
) -> DataFrame:
    """Labelled rows with a temporal split; brand and category ride along."""
    labelled = gold.filter(F.col("stockout_next_7d").isNotNull())
    return with_split(labelled, "ds", train_share).select(*_feature_columns(created_at, split=True))


def unsplit_features(gold: DataFrame, created_at: Column | None = None) -> DataFrame:
    """``feature_table`` without the split, which depends on all days: a day's rows follow from its gold rows."""
    labelled = gold.filter(F.col("stockout_next_7d").isNotNull())
    return labelled.select(*_feature_columns(created_at, split=False))


def feature_days(counts: DataFrame, train_share: float = TRAIN_SHARE) -> DataFrame:
    """event_date, rows, split: a row a day, from the days' row counts (event_date, rows)."""
    ranks = ranks_of_counts(counts.withColumnRenamed("rows", "_rows"), "event_date")
    return counts.join(ranks, "event_date").select(
        "event_date", "rows", side_of(F.col("day_rank"), train_share).alias("split")
    )


def loader_rows(gold: DataFrame, side: str, train_share: float = TRAIN_SHARE) -> DataFrame:
    """Wide rows of one side: 'train', or 'valid' (the later days)."""
    sides = {"train": "train", "valid": "test"}
    labelled = gold.filter(F.col("stockout_next_7d").isNotNull())
    return (
        with_split(labelled, "ds", train_share)
        .filter(F.col("split") == sides[side])
        .select(
            "store_id",
            "product_id",
            "ds",
            F.col("stockout_next_7d").alias("label"),
            *LOADER_FEATURES,
        )
    )


def prepared(features: DataFrame, *kept: str) -> DataFrame:
    """The inputs as doubles with NULL and NaN as 0, and the label as 0/1."""
    numbers = []
    for name in FEATURES:
        value = F.col(name).cast("double")
        numbers.append(F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0)).alias(name))
    return features.select(*kept, *numbers, flag_to_int("stockout_label").alias("label"))
